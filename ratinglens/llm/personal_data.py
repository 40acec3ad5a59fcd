"""Operator 9: personal data, proposed by generous generators and chosen by gradient boosted trees."""

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import boost, predict
from .models import bounded_sample, train_in_one_task
from .staging import type_of

# Kinds in the order in which spans at one place are listed; the last two are the method's own
KINDS = ("email", "ip", "card", "phone", "address_text", "number")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ADDRESS_TEXT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:@|[(\[](?:at|AT)[)\]])\x20?[A-Za-z0-9-]{1,64}(?:(?:\.|\x20?[(\[](?:dot|DOT)[)\]]\x20?)[A-Za-z0-9-]{1,64})+")
NUMBER = re.compile(r"\+?\(?[0-9][\x20().0-9-]{5,}[0-9]")
CUES = re.compile(r"(?:phone|tel|call|mobile|fax|mail|contact|card|visa|account|iban|ssn|passport|ip|addr)[a-z]*[^A-Za-z0-9]*$", re.I)
GATE = r"[0-9@]|[(\[](at|AT)[)\]]"
PHONE_CUE = re.compile(r"(?<![A-Za-z])(?:(?:tele)?phone|tel|call|mobile|cell|fax)[^A-Za-z0-9]*$", re.I)
NO_PHONE = re.compile(r"(?:19|20)[0-9]{2}[.-][0-9]{1,2}[.-][0-9]{1,2}(?![0-9])|[0-9]{1,2}[.-][0-9]{1,2}[.-](?:19|20)[0-9]{2}(?![0-9])|97[89][\x20-]|[0-9]+\.[0-9]+$|[0-9]+(?:\.[0-9]+){3}$")
AT_DOT = ((" (at) ", " (dot) "), ("(at)", "(dot)"), (" [at] ", "."), (" @ ", "."), (" [AT] ", " [DOT] "), ("[at]", "."))

TRAINING_BOUND = 5000           # documents with candidates that the trees are fitted on, at most
PRECISION = 0.95                # least share of right redactions at the threshold
SPANS = "array<struct<start:bigint,order:int,end:bigint,kind:string,base:boolean,score:double>>"


class Span(NamedTuple):
    start: int
    order: int
    end: int


def luhn(digits: str) -> bool:
    """Whether the digits, every second one from the right doubled, add up to a multiple of ten."""
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else digit * 2 - 9 * (digit > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    """From each @ to the left as far as an address may go: the leftmost match, found without trying every start."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield Span(start, 0, done)
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Spans of the four base kinds by place; matches that fail their check are dropped without another try."""
    found = list(_emails(text))
    found += [Span(m.start(), 1, m.end()) for m in IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    found += [Span(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    found += [Span(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found)


def proposals(text: str) -> list[Span]:
    """Spans that may be personal data; generators overlap each other and the base kinds."""
    found = [Span(m.start(), 4, m.end()) for m in ADDRESS_TEXT.finditer(text)] if "@" in text or re.search(GATE, text) else []
    found += [Span(m.start(), 5, m.end()) for m in NUMBER.finditer(text)]
    return sorted(found)


def _class(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isalpha() else 2 if c.isdigit() else 3


def span_features(text: str, span: Span) -> list[float]:
    """Format: lengths, groups, signs and check digit. Context: the characters beside the span and a cue word before it."""
    body = text[span.start:span.end]
    groups = re.findall("[0-9]+", body) or [""]
    count = lambda chars: sum(c in chars for c in body)
    return [len(body), sum(map(len, groups)), len(groups), count(" "), count("-"), count("."), count("()[]"), body[0] == "+",
            "@" in body, sum(c.isalpha() for c in body), max(map(len, groups)), len(groups[0]), len(groups[-1]),
            _class(text[span.start - 1:span.start]), _class(text[span.end:span.end + 1]),
            bool(CUES.search(text[max(0, span.start - 24):span.start])), span.order, luhn("".join(groups)),
            all(len(g) <= 3 for g in groups)]


def _overlaps(span: Span, others: list[Span]) -> bool:
    return any(span.start < o.end and o.start < span.end for o in others)


def calibrated_threshold(scores: np.ndarray, right: np.ndarray) -> float:
    """The least score at which the share of right redactions, made monotone in the score, reaches PRECISION; 2 if none does."""
    blocks = []                                         # share, count, least score; by isotonic regression
    for score in np.unique(scores):
        hits = right[scores == score]
        blocks.append((hits.mean(), len(hits), score))
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            (share, count, _), (before, more, least) = blocks.pop(), blocks.pop()
            blocks.append(((share * count + before * more) / (count + more), count + more, least))
    return float(min((least for share, _, least in blocks if share >= PRECISION), default=2.0))


def ruled_out(text: str, span: Span) -> bool:
    """Whether format says that a proposal is no added kind: a piece of a longer word, not 7 to 15 digits, a date, an
    ISBN, a decimal or four numbers with dots; an address in words needs letters at its end."""
    body = text[span.start:span.end]
    if span.order == 4:
        return not re.search(r"[A-Za-z]{2,}$", body)
    beside = text[max(0, span.start - 1):span.start] + text[span.end:span.end + 1]
    return any(c.isalnum() or c == "_" for c in beside) or not 7 <= len(_digits(body)) <= 15 or bool(NO_PHONE.match(body))


def weak_label(text: str, span: Span) -> int | None:
    """1 or 0 for a proposal that overlaps no base span, by format and cue; None where neither tells, such as for a
    number grouped like a national phone number without a word for it before."""
    if ruled_out(text, span):
        return 0
    body = text[span.start:span.end]
    if span.order == 4:
        return None if "@" in body else 1
    if PHONE_CUE.search(text[max(0, span.start - 24):span.start]):
        return 1
    return None if len(_digits(body)) >= 10 and len(re.findall("[0-9]+", body)) >= 3 else 0


def rewritten(text: str, base: list[Span], turn: int) -> tuple[str, list[tuple[Span, int]]]:
    """The text with base spans in the form of the added kinds or of decoys, and (place, label) of each.

    Addresses are spelled out and phone numbers lose the plus or the country's code, with other signs in between: 1. IPs get a part over 255, turn
    into a version or a decimal, and cards get a wrong check digit or turn into a date or a plain number: 0. ``turn`` picks the form.
    """
    parts, places, done, length = [], [], 0, 0
    for span in base:
        if span.start < done:
            continue
        body, digits = text[span.start:span.end], _digits(text[span.start:span.end])
        if span.order == 0:
            at, dot = AT_DOT[turn % len(AT_DOT)]
            local, domain = body.split("@", 1)
            body = local + at + domain.replace(".", dot)
        elif span.order == 1:
            first, second, third, last = body.split(".")
            body = (f"{int(first) + 256}.{second}.{third}.{last}", f"{second}.{third}.{digits[:4]}", f"{first}.{digits[:7]}")[turn % 3]
        elif span.order == 2:
            date = (f"{1950 + int(digits[:2]):04}", f"{int(digits[2:4]) % 12 + 1:02}", f"{int(digits[4:6]) % 28 + 1:02}")
            body = (body[:-1] + str((int(body[-1]) + 1) % 10), "-".join(date), digits[:7 + turn % 5], ".".join(date[::-1]))[turn % 4]
        else:
            national = re.sub(r"^\+[0-9]{1,3}[\x20.-]+", "", body)
            sign = turn % 5
            body = body[1:] if not sign or len(_digits(national)) < 7 else national if sign == 1 else "- ."[sign - 2].join(re.findall("[0-9]+", national))
        parts += [text[done:span.start], body]
        length += span.start - done
        places.append((Span(length, span.order, length + len(body)), int(span.order in (0, 3))))
        length, done, turn = length + len(body), span.end, turn + 1
    return "".join(parts) + text[done:], places


def examples(text: str, turn: int) -> Iterator[tuple[list[float], int]]:
    """(features, label) of a document's proposals: valid addresses and phone numbers, other proposals that format or
    cue tells apart, and base spans rewritten. Valid IPs and cards teach nothing, as what is added is neither."""
    base = base_spans(text)
    for span in proposals(text):
        over = [b for b in base if _overlaps(span, [b])]
        label = weak_label(text, span) if not over else 1 if all(b.order in (0, 3) for b in over) else None
        if label is not None:
            yield span_features(text, span), label
    if base:
        changed, places = rewritten(text, base, turn)
        for span in proposals(changed):
            labels = {label for place, label in places if _overlaps(span, [place])}
            if len(labels) == 1:
                yield span_features(changed, span), labels.pop()


def _fit(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
    """Trees fitted on two of three documents and a threshold calibrated on the third, on the labels of ``examples``."""
    x, y, third, number = [], [], [], 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            for features, label in examples(text, number // 3):
                x.append(features)
                y.append(label)
                third.append(number % 3 == 0)
            number += 1
    if not x:
        return {}
    x, y, third = np.array(x, float), np.array(y, float), np.array(third, bool)
    if len(np.unique(y[~third])) < 2:
        return {}
    model = boost(x[~third], y[~third])
    p = predict(model, x[third])
    return model | {"threshold": np.array([calibrated_threshold(p, y[third])])}


def train(docs: DataFrame, bound: int = TRAINING_BOUND, text: str = "text", doc_id: str = "doc_id") -> dict[str, np.ndarray]:
    """Trees and threshold from at most ``bound`` different documents with digits or addresses and at most
    ``models.SAMPLE_BYTES`` bytes of text; empty if they show only one class.

    Labels come from the base kinds' patterns, rewritten, and from format and cue, which are features as well, so the
    threshold's precision measures agreement with those rules and not with labels by hand.
    """
    able = docs.select(F.col(text).alias("text"), F.xxhash64(doc_id).alias("place")).where(F.col("text").rlike(GATE))
    return train_in_one_task(bounded_sample(able, ["place", "text"], "text", bound), _fit, ["place", "text"])


def select_spans(text: str, model: dict[str, np.ndarray], scores: list[float], proposed: list[Span], base: list[Span]) -> list[tuple]:
    """Base spans, and of the others those over the threshold that overlap no better one."""
    chosen, limit = list(base), model["threshold"][0] if model else 2.0
    added = []
    for score, span in sorted(zip(scores, proposed, strict=True), key=lambda s: (-s[0], s[1])):
        if score >= limit and not _overlaps(span, chosen):
            chosen.append(span)
            added.append((*span, False, score))
    return sorted([(*s, True, 1.0) for s in base] + added)


def find_personal_data(docs: DataFrame, model: dict[str, np.ndarray], text: str = "text", doc_id: str = "doc_id", mask: bool = False) -> DataFrame:
    """(doc_id, spans[, masked]) of each row: where personal data stands, in code points, end exclusive.

    Spans of the base kinds always count. Generators propose further, overlapping spans; boosted trees score them
    by format and context, and those over the calibrated threshold are added unless they overlap a span that
    counts or are ruled out by format. The trees learn from addresses and phone numbers, as they stand and rewritten, and from what format or cue
    rules out or in; the threshold's precision is the one on such labels, not on labels by hand. ``mask`` adds the text
    with each span replaced by its kind in brackets.

    Texts without a digit or an @ are told apart before Python sees them. Null texts have no spans and stay null
    when masked. Ids are passed through, null or repeated; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span_type = pa.list_(pa.struct([("start", pa.int64()), ("order", pa.int32()), ("end", pa.int64()), ("kind", pa.string()),
                                        ("base", pa.bool_()), ("score", pa.float64())]))
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                texts = part.column(1).to_pylist()
                base = [base_spans(t) if t else [] for t in texts]
                proposed = [[p for p in proposals(t) if not _overlaps(p, b) and not ruled_out(t, p)] if t and model else [] for t, b in zip(texts, base, strict=True)]
                rows = [span_features(t, p) for t, ps in zip(texts, proposed, strict=True) for p in ps]
                scores = iter(predict(model, np.array(rows, float)).tolist() if rows else [])
                found = [select_spans(t, model, [next(scores) for _ in p], p, b) for t, p, b in zip(texts, proposed, base, strict=True)]
                columns = [part.column(0), pa.array([[
                    {"start": s, "order": o, "end": e, "kind": KINDS[o], "base": is_base, "score": score}
                    for s, o, e, is_base, score in spans] for spans in found], span_type)]
                if mask:
                    columns.append(pa.array([masked(w, spans) for w, spans in zip(part.column(2).to_pylist(), found, strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "spans", "masked"][:len(columns)])

    gated = F.when(F.col(text).rlike(GATE), F.col(text)).alias("gated")
    columns = [F.col(doc_id).alias("doc_id"), gated] + [F.col(text).alias("whole")] * mask
    return docs.select(*columns).mapInArrow(run, f"doc_id {type_of(docs, doc_id)}, spans {SPANS}" + ", masked string" * mask)


def masked(text: str | None, spans: list[tuple]) -> str | None:
    """The text with spans replaced from the left; of overlapping spans the first one's kind stands for all."""
    if text is None:
        return None
    parts, done = [], 0
    for start, order, end, *_ in spans:
        if start >= done:
            parts += [text[done:start], f"[{KINDS[order]}]"]
        done = max(done, end)
    return "".join(parts) + text[done:]
