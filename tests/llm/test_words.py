"""Words of texts as arrays: hashes that built words do not defeat."""

import pyarrow as pa

from ratinglens.llm.word_arrays import text_slices, words_of


def _hashes(*texts):
    return [h for _, data, offsets in text_slices(pa.array(texts)) for h in words_of(data, offsets).hashes.tolist()]


def test_words_that_collide_under_powers_of_one_number():
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    a, b, again = _hashes(f"{word} {other}", word.upper())
    assert a != b and a == again


def test_a_word_hashes_alike_wherever_it_stands():
    hashes = _hashes("one two", "\n\n two", None, "two", "", f"{'x' * 70_000} two{' ' * 3000}")
    assert len(hashes) == 6 and len(set(hashes)) == 3 and len({hashes[i] for i in (1, 2, 3, 5)}) == 1
    assert len(set(_hashes("ab ba a b aa aab aba baa"))) == 8
