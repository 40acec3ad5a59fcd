"""Operators against plain Python on small tables."""

import itertools
import re
from collections import Counter, defaultdict
from random import Random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ratinglens.llm import (
    components,
    decontamination,
    language_id,
    models,
    near_duplicates,
    packing,
    personal_data,
    quality_classifier,
    quality_rules,
    secret_scan,
    trigram_queries,
)

from .conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def components_by_pairs(texts, size, percent):
    sets = {}
    for key, text in texts.items():
        w = words(text)
        sets[key] = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    root = {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in keys}


@pytest.fixture(scope="module")
def edited(spark):
    """Groups of edited copies around the limit, a chain, and strangers; about 240 texts."""
    random = np.random.default_rng(5)
    base = [" ".join(f"w{x}" for x in random.integers(0, 3000, 150)) for _ in range(6)]
    texts = list(base)
    for text in base:
        for share in np.linspace(0.005, 0.09, 36):
            w = text.split()
            texts.append(" ".join(f"n{random.integers(1_000_000)}" if random.random() < share else x for x in w))
    w = base[0].split()
    for i in range(12):
        w = w[4:] + [f"c{i}x{j}" for j in range(4)]
        texts.append(" ".join(w))
    return {i: t for i, t in enumerate(texts)}


@pytest.mark.parametrize(("size", "percent", "rows", "bands"), [(3, 85, 6, 32), (5, 80, 5, 36)])
def test_near_duplicates(spark, docs, edited, size, percent, rows, bands):
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()} | {10_000 + k: t for k, t in edited.items()}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(df, size, percent, rows, bands).collect()}
    assert found == components_by_pairs(texts, size, percent)


def test_components(spark):
    random = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in random.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1060)]
    root = {}
    for a, b in links:
        for x in (a, b):
            root.setdefault(x, x)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    found = components.connected_components(spark.createDataFrame(links, "a int, b int")).collect()
    looped = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.root for r in found} == {k: v for k, v in root.items() if k not in looped} and len(found) == len(root) - len(looped)


def test_secret_spans(spark, docs):
    for row in secret_scan.find_secrets(docs).select("row.text", "spans").collect():
        expected = sorted((m.start(), order, m.end()) for order, rule in enumerate(secret_scan.RULES)
                          for m in re.finditer(rule.pattern, row.text) if len(m[rule.group]) >= rule.min_length)
        assert [(s.start, s.order, s.end) for s in row.spans] == expected


def test_secrets_by_hundreds_of_rules(spark):
    """Each rule finds its own text and no other, however many longs the rules' trigrams fill."""
    rules = tuple(secret_scan.Rule(f"kind{i}", rf"k{i:03}x[a-f]{{3}}z{i:03}q[0-9]+") for i in range(150))
    assert len(secret_scan.indexed_trigrams(rules)) > 4 * secret_scan.WORD_BITS
    texts = [(i, f"before k{i:03}xabcz{i:03}q7{i} after") for i in range(150)] + [(None, "k007xabcz007q1"), (200, "k007xabcz008q1"), (201, None)]
    found = secret_scan.find_secrets(spark.createDataFrame(texts, "doc_id int, text string"), rules).select("row.doc_id", "spans").collect()
    kinds = {r.doc_id: [(s.kind, s.start) for s in r.spans] for r in found}
    assert kinds == {i: [(f"kind{i}", 7)] for i in range(150)} | {None: [("kind7", 0)], 200: [], 201: []}


def test_secrets_without_any_indexed_rule(spark):
    rules = (secret_scan.Rule("digits", "[0-9]{4,}"),)
    found = secret_scan.find_secrets(spark.createDataFrame([(1, "a 12345")], "doc_id int, text string"), rules).first()
    assert [(s.start, s.end) for s in found.spans] == [(2, 7)]


def test_base_kinds_as_their_patterns_are_given(spark, docs):
    """The base kinds against patterns and least lengths as stated, in plain Python; the rules fold some lengths into the pattern."""
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    stated = (("assign", assign, 2, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16))
    edge = ["AKIA" + "B" * n for n in (12, 13, 14, 15)] + ["f" * n for n in (14, 15, 16, 17)] + ["Token:" + "a" * n for n in (11, 12)]
    edge += ["AKIAAKIA" + "C" * 10, "xAPIKEY='" + "0a" * 9 + "'", "a\u00e9\U0001F600 secret = " + "1" * 12 + " g" + "0" * 16]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(-i - 1, t) for i, t in enumerate(edge)], "doc_id bigint, text string"))
    for row in secret_scan.find_secrets(rows).select("row.text", "spans").collect():
        expected = sorted((m.start(), order, m.end(), kind) for order, (kind, pattern, group, least) in enumerate(stated)
                          for m in pattern.finditer(row.text) if len(m[group]) >= least)
        assert [tuple(s) for s in row.spans if s.order < 3] == expected


@pytest.mark.parametrize("rule", secret_scan.RULES, ids=lambda r: r.kind)
def test_trigram_query_is_necessary(rule):
    samples = ["API_KEY = abcdefghijkl", "passwd:abcdefghijkl", "AKIAABCDEFGHIJKLMN", "ghp_" + "a1" * 20, "xoxb-12345678901", "AIza" + "b" * 35,
               "sk_live_" + "a" * 20, "eyJabcdefghij.eyJabcdefghij.abcdefghij", "-----BEGIN EC PRIVATE KEY-----", "0123456789abcdef"]
    matching = [s.lower() for s in samples if re.search(rule.pattern, s)]
    assert matching and all(any(all(t in s for t in a) for a in rule.query) for s in matching)
    assert trigram_queries.trigram_query("ab[c-z]*") == trigram_queries.ANY


def test_personal_base_spans(docs):
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    extra = ["a@b a@b.c.d@e.f ..@x.y", "1.2.3.4.5.6.7.8.9 300.1.1.1 01.002.3.255", "@@a@b.c@", "a.b@c-.d-e f@g.", "1.2.3.4@5.6"]
    for text in [r.text for r in docs.select("text").collect()] + extra:
        found = personal_data.base_spans(text)
        assert [(s.start, s.end) for s in found if s.order == 0] == [m.span() for m in email.finditer(text)]
        assert [(s.start, s.end) for s in found if s.order == 1] == [m.span() for m in ip.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]


def test_personal_data_outside_the_base_kinds(spark):
    """Spelled-out addresses and national phone numbers are added; dates, ISBNs, decimals and pieces of hashes are not."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = personal_data.train(documents)
    added = {
        1: ("write to jane.doe (at) mail3 (dot) example (dot) com today", "jane.doe (at) mail3 (dot) example (dot) com"),
        2: ("call us now on (415) 555-2671 or later", "(415) 555-2671"), 3: ("a.b (at) host (dot) org", "a.b (at) host (dot) org"),
        4: ("on 2024-01-15 we had 3.14159265 and 978-3-16-148410-0 here", None), 5: ("token 3c4226790fc3f8022 or 10.0.0.256 x", None)}
    df = spark.createDataFrame([(k, text) for k, (text, _) in added.items()], "doc_id bigint, text string")
    for r in personal_data.find_personal_data(df, model).collect():
        text, expected = added[r.doc_id]
        assert [text[s.start:s.end] for s in r.spans if not s.base] == [expected] * (expected is not None)


def test_quality_measures(docs):
    for r in quality_rules.quality_rules(docs).select("row.text", *quality_rules.MEASURES).collect():
        w = WORD.findall(r.text)
        three = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        again = {i + k for i in range(len(w) - 2) for k in range(3) if three[tuple(w[i:i + 3])] > 1}
        lines = [x for x in r.text.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (len(w), sum(map(len, w)), len(again), len(lines) - len(set(lines)))


def leaked(texts, items):
    """Documents with a stretch of words equal to an item's, substituted ones costing two: every alignment is tried."""
    return {k: sorted(v) for k, v in leaks_with_counts(texts, items).items()}


def leaks_with_counts(texts, items):
    """For each document with a leak the items and the most equal words of a stretch that is one."""
    found = defaultdict(dict)
    for key, text in texts.items():
        a = np.array(words(text), object)
        for item, passage in items.items():
            b = np.array(words(passage), object)
            if not set(a) & set(b):
                continue
            for shift in range(-len(b) + 8, len(a) - 7):
                low, high = max(0, shift), min(len(a), shift + len(b))
                same = a[low:high] == b[low - shift:high - shift]
                if same.sum() >= 11:
                    score = best = equal = most = 0
                    for x in same:
                        score, equal = (score + 1, equal + 1) if x else (score - 2, equal)
                        if score <= 0:
                            score = equal = 0
                        if score > best:
                            best, most = score, equal
                    if most >= min(13, -(-len(b) * 80 // 100)):
                        found[key][item] = max(most, found[key].get(item, 0))
    return found


def test_long_items_are_counted_whole(spark):
    random = Random(4)
    items = {i: " ".join(f"w{random.randint(0, 400)}" for _ in range(n)) for i, n in enumerate((200, 90, 60, 3000, 20))}
    texts = {}
    for name in range(60):
        w = items[name % 5].split()
        begin = random.randint(0, max(0, len(w) - 30))
        part = w[begin:begin + random.choice([20, 80, 5000])]
        rate = random.choice([0, 0.1, 0.3])
        texts[name] = " ".join(["a"] * random.randint(0, 90) + [f"s{i}" if random.random() < rate else x for i, x in enumerate(part)] + ["b"] * random.randint(0, 9))
    df = spark.createDataFrame([*texts.items(), (0, texts[1]), (None, items[0])], "doc_id bigint, text string").repartition(5)
    found = {r.doc_id: (r["items"], r.n_matched) for r in decontamination.find_leaks(df, spark.createDataFrame(items.items(), "item_id int, text string")).collect()}
    assert found.pop(None) == ([0], 200)
    both = leaks_with_counts({0: texts[0], 1: texts[1]}, items)
    expected = {k: (sorted(v), max(v.values())) for k, v in leaks_with_counts(texts, items).items()}
    merged = {**both.get(0, {}), **both.get(1, {})}
    expected[0] = (sorted(merged), max([*both.get(0, {}).values(), *both.get(1, {}).values()]))
    assert found == expected and max(n for _, n in expected.values()) > 1000


@pytest.mark.parametrize("n", [0, 1, 5, 40])
def test_best_stretch(n):
    random = np.random.Generator(np.random.PCG64(n))
    for share in (0.3, 0.7, 0.9):
        for _ in range(50):
            equal = random.random(n) < share
            a = np.ones((1, n), np.int64)
            assert decontamination._best_stretch(equal) == decontamination.longest_overlap(a, np.where(equal, 1, 2)[None, :])[0]


def test_leaks(spark, docs):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = {r.item_id: r.text for r in benchmark.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for number, passage in enumerate(items.values()):                   # passages with every ninth word replaced
        w = passage.split()
        texts[100_000 + number] = " ".join(["before"] * number + [f"s{i}" if i % 9 == 4 else x for i, x in enumerate(w)] + ["after"])
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r.doc_id: (r["items"], r.n_matched) for r in decontamination.find_leaks(df, benchmark).collect()}
    assert found == {k: (sorted(v), max(v.values())) for k, v in leaks_with_counts(texts, items).items()}
    assert sum(k >= 100_000 for k in found) > 0.9 * len(items)


def test_leaks_with_any_permitted_substitutions(spark):
    """All patterns for items of 8 to 14 words, random ones for longer items; those with a leak are found, no others."""
    random, items, texts, expected = np.random.default_rng(3), {}, {}, {}

    def most_equal(same):                       # of the stretch with the best score, of equal ones the one that ends first and is shortest
        sums = {(i, j): sum(1 if x else -2 for x in same[i:j]) for i in range(len(same)) for j in range(i + 1, len(same) + 1)}
        i, j = max(sums, key=lambda s: (sums[s], -s[1], s[0]))
        return sum(same[i:j])

    for n in (*range(8, 15), 15, 16, 18, 25, 38):
        items[n] = " ".join(f"i{n}x{k}" for k in range(n))
        most = n - min(13, -(-n * 80 // 100))
        patterns = [p for k in range(most + 1) for p in itertools.combinations(range(n), k)] if n < 15 else [
            np.flatnonzero(random.random(n) < share) for share in (0.1, 0.2) for _ in range(100)]
        for p in patterns:
            key = len(texts)
            texts[key] = " ".join([f"b{key}", *(f"s{key}x{k}" if k in p else f"i{n}x{k}" for k in range(n)), f"e{key}"])
            if most_equal([k not in p for k in range(n)]) >= min(13, -(-n * 80 // 100)):
                expected[key] = [n]
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    benchmark = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    assert {r.doc_id: r["items"] for r in decontamination.find_leaks(df, benchmark).collect()} == expected


def test_packing(docs):
    sizes = packing.Sizes((64, 256, 512))
    counted = {r.doc_id: len(WORD.findall(r.text)) for r in docs.collect()}
    rows = packing.pack(docs, sizes, shard_tokens=20_000).collect()
    covered, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        covered[r.doc_id].append((r.start, r.length))
        bins[r.bin_id, r.bin_size].append((r.offset, r.length))
    for doc, n in counted.items():
        place = 0
        for start, length in sorted(covered[doc]):
            assert start == place
            place += length
        assert place == n
    for (_, size), parts in bins.items():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert size == sizes.smallest(place)
    assert sum(counted.values()) / sum(size for _, size in bins) > 0.97
    assert sorted(map(tuple, packing.pack(docs.repartition(5), sizes, shard_tokens=20_000).collect())) == sorted(map(tuple, rows))


def test_smaller_bins_are_opened_when_little_is_left():
    bins, offsets, lengths = packing.best_fit(np.array([500, 60, 30, 20]), packing.Sizes((64, 256, 512)))
    assert bins.tolist() == [0, 1, 2, 2] or bins.tolist() == [0, 1, 1, 1]
    assert sum(lengths) <= 512 + 256


def least_cost(pieces, sizes):
    """Over all ways to put the pieces into bins."""
    def put(i, bins):
        if i == len(pieces):
            return sum(sizes.cost(sizes.smallest(b)) for b in bins)
        new = put(i + 1, [*bins, pieces[i]])
        return min([new] + [put(i + 1, [*bins[:k], b + pieces[i], *bins[k + 1:]]) for k, b in enumerate(bins) if b + pieces[i] <= sizes.lengths[-1]])

    return put(0, [])


def test_packing_costs_little_more_than_the_best():
    random, paid, best = Random(9), 0, 0
    for _ in range(60):
        sizes = packing.Sizes(random.choice([(32, 64, 128), (16, 64, 256), (100,)]), random.choice([1, 8, 40]), random.choice([64, 500, 1e6]))
        pieces = sorted((random.randint(1, sizes.lengths[-1]) for _ in range(7)), reverse=True)
        bins, offsets, lengths = packing.best_fit(np.array(pieces), sizes)
        filled = np.bincount(bins, weights=pieces)
        assert [sizes.smallest(int(f)) for f in filled] == lengths
        mine, least = sum(map(sizes.cost, lengths)), least_cost(pieces, sizes)
        assert least - 1e-6 <= mine <= 1.35 * least
        paid, best = paid + mine, best + least
    assert paid < 1.04 * best


def test_several_sizes_win():
    """Bins of one length only, and opening the largest always, both cost more than the chosen mixture."""
    random, sizes = np.random.default_rng(5), packing.Sizes()
    pieces = np.sort(np.minimum(random.lognormal(5.5, 1.2, 4000).astype(int) + 1, 2048))[::-1]
    _, _, lengths = packing.best_fit(pieces, sizes)
    paid = lambda lengths: sum(map(sizes.cost, lengths))
    for size in sizes.lengths:
        one = [sizes.smallest(u) for u in packing._packed(pieces, sizes, (size,))[2]]
        assert paid(lengths) <= paid(one)
    assert len(set(lengths)) > 1 and paid(lengths) < paid([sizes.smallest(u) for u in packing._packed(pieces, sizes, (2048,))[2]])


def test_rows_alike_are_dealt_to_many_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "REPEATS", 1000)
    df = spark.range(40_000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("a b c d e").alias("text"))
    shards = packing.pack(df, shard_tokens=20_000).select((F.col("bin_id") / (1 << 32)).cast("int").alias("shard"), "length").groupBy("shard").count().collect()
    assert len(shards) == 10 and sum(r["count"] for r in shards) == 40_000 and max(r["count"] for r in shards) < 5000


def test_classifiers_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    weights = quality_classifier.train(documents, labels.where(models.fold("doc_id", 3) != 1))
    scored = quality_classifier.score(documents, weights).join(labels, "doc_id").where(models.fold("doc_id", 3) == 1).toPandas()
    assert ((scored.predicted == scored.quality).mean()) > 0.93 and scored[scored.quality == 1].predicted.mean() > 0.97
    model = language_id.train(documents.where(models.fold("doc_id", 4) != 2))
    found = language_id.identify(documents, model).join(documents.select("doc_id", "lang"), "doc_id").where(models.fold("doc_id", 4) == 2)
    assert found.where("lang = lang_pred").count() > 0.98 * found.count()


def test_codewords_differ():
    for n in (2, 4, 6, 7, 30):
        code = language_id.codewords(n)
        assert len(np.unique(code, axis=0)) == n


def test_pipeline(spark, docs):
    """The stages' survivors, made in plain Python from each stage's own input."""
    stage = dict(corpus_pipeline.STAGES)
    good = stage["quality_rules"](spark, docs, SMALL)
    clean = stage["line_dedup"](spark, good, SMALL).cache()
    texts = {r.doc_id: r.text for r in clean.collect()}
    groups = components_by_pairs(texts, 5, 80)
    single = {k: texts[k] for k, (_, root) in groups.items() if root == k}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    leaks = leaked(single, items)
    expected = {k: len(words(t)) for k, t in single.items() if k not in leaks}
    found = corpus_pipeline.run(spark, SMALL).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n for r in found} == expected and len(expected) > 100


@pytest.mark.parametrize("bits", [3, 26, 60])
def test_repeated_words_whatever_the_hashes(spark, monkeypatch, bits):
    """With 60 bits for the place four are left for the hash, so that different windows clash in almost every text; with
    three, most texts have more words than there are places."""
    monkeypatch.setattr(quality_rules, "_PLACE_BITS", bits)
    random = Random(3)
    texts = [" ".join(random.choice("abcde") for _ in range(n)) for n in (0, 3, 4, 5, 12, 20, 40, 60, 90)]

    def expected(text):
        words = text.split()
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)})

    found = spark.createDataFrame(enumerate(texts), "id int, text string").select(
        "id", quality_rules.measures(F.col("text"))["n_repeat_words"]).collect()
    assert {r["id"]: r["n_repeat_words"] for r in found} == {i: expected(t) for i, t in enumerate(texts)}
