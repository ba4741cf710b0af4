"""Personal data: fixed patterns, and more spans from a character-level tagger.

The patterns give the base spans. A bidirectional LSTM with CRF transitions is trained on labelled
spans: windows around the base spans of a bounded sample of documents, the same windows with other digits,
and with forms that the patterns don't know (labelled) or that only look alike (not labelled).

Every span has a digit or an ``@``, so windows are laid around those, everywhere in the text; other
text holds nothing. Windows overlap. Their tag probabilities are averaged for each
character, weighted by its distance to the window's edge, and one best path is decoded over the whole
stretch, so that no span depends on where a window happened to begin. A span is added if the
tagger is sure of it, it overlaps no base span, and its digits fit its kind.

Defined results: a null or empty text holds nothing; a null ``doc_id`` is passed on; repeated rows get the
same spans; an empty table gives no rows; other columns are passed over. Texts are searched whole, in
time proportional to their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.bilstm import Tagger
from touchline.llm.words import text_slices

KINDS = ("email", "ip", "card", "phone")
#: Documents with a digit or an @ from which training windows are taken, at most.
SAMPLE_DOCUMENTS = 400
SAMPLE_WINDOWS = 1500
EPOCHS = 10
WINDOW = 48
STRIDE = 24
#: Characters around a digit or @ that are looked at, and the gap that still joins two of them.
AROUND = 16
SURE = 0.6
BATCH = 512

_TRIGGER = np.zeros(256, bool)
_TRIGGER[[*range(48, 58), 64]] = True
#: The patterns of the base spans.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their @: a local part before it cannot hold another one."""
    done = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and _LOCAL.match(text[begin - 1]):
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
            done = domain.end()
        # Nothing before this @ can be part of a later local part.
        done = max(done, at + 1)
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """Spans by kind, then by place."""
    found: list[Span] = [("email", a, b) for a, b in _emails(text)]
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
                     for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 37:
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text)
              if 8 <= len(_digits(m.group())) <= 15]
    return found


def codes_of(text: str) -> np.ndarray:
    """A code below 128 for every character; all beyond ASCII share the last one."""
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32),
                      127).astype(np.int64)


def stretches(codes: np.ndarray) -> list[tuple[int, int]]:
    """Parts of a text around its digits and @ signs."""
    at = np.flatnonzero(_TRIGGER[codes])
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > 2 * AROUND)
    first = np.append(at[0], at[cut + 1])
    last = np.append(at[cut], at[-1])
    return [(max(0, int(a) - AROUND), min(len(codes), int(b) + AROUND + 1))
            for a, b in zip(first, last, strict=True)]


def _windows(begin: int, end: int) -> list[int]:
    return list(range(begin, max(begin + 1, end - WINDOW + STRIDE), STRIDE))


def _cut(codes: np.ndarray, start: int) -> np.ndarray:
    part = codes[start:start + WINDOW]
    return np.pad(part, (0, WINDOW - len(part)), constant_values=32)


# --- training -----------------------------------------------------------------------------------


def _tagged(spans: list[Span], start: int) -> np.ndarray:
    """Tags of a window: 0 outside, 1 + 2k where a span of kind k begins, 2 + 2k inside."""
    tags = np.zeros(WINDOW, np.int64)
    for kind, a, b in spans:
        first, last = max(a - start, 0), min(b - start, WINDOW)
        if first < last:
            k = KINDS.index(kind)
            tags[first:last] = 2 + 2 * k
            if a >= start:
                tags[a - start] = 1 + 2 * k
    return tags


def _number(random: np.random.Generator, count: int) -> str:
    return "".join(str(d) for d in random.integers(0, 10, count))


def _with_check_digit(digits: str) -> str:
    return next(digits[:-1] + str(d) for d in range(10) if luhn(digits[:-1] + str(d)))


def _forms(random: np.random.Generator) -> list[tuple[str | None, str]]:
    """One value of each form: kinds, and look-alikes without a kind."""
    n, card = _number, _with_check_digit(_number(random, 16))
    name = "".join(chr(97 + c) for c in random.integers(0, 26, 8))
    octets = ".".join(str(o) for o in random.integers(0, 256, 4))
    return [
        ("email", f"{name[:4]}.{name[4:]}@{name[2:7]}.org"), ("email", f"{name}@[{octets}]"),
        ("ip", octets), ("card", card),
        ("card", " ".join(card[i:i + 4] for i in range(0, 16, 4))),
        ("card", ".".join(card[i:i + 4] for i in range(0, 16, 4))),
        ("phone", f"+{random.integers(1, 99)} {n(random, 3)} {n(random, 3)} {n(random, 4)}"),
        ("phone", f"({n(random, 3)}) {n(random, 3)}-{n(random, 4)}"),
        ("phone", f"+1 ({n(random, 3)}) 555-{n(random, 4)}"),
        (None, n(random, int(random.integers(1, 8)))), (None, f"{n(random, 1)}.{n(random, 1)}"),
        (None, f"20{n(random, 2)}-0{random.integers(1, 10)}-1{n(random, 1)}"),
        (None, f"@{name[:6]}"), (None, f"{n(random, 2)}:{n(random, 2)}"),
        (None, f"{n(random, 3)},{n(random, 3)}.{n(random, 2)}"),
        (None, "".join("0123456789abcdef"[c] for c in random.integers(0, 16, 32))),
    ]


def training_windows(texts: list[str], seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags of at most ``SAMPLE_WINDOWS`` windows and as many changed ones."""
    random = np.random.default_rng(seed)
    codes, tags = [], []
    share = max(1, SAMPLE_WINDOWS // max(len(texts), 1))  # so that no text supplies most of them
    for text in texts:
        spans, all_codes = base_spans(text), codes_of(text)
        starts = [s for begin, end in stretches(all_codes) for s in _windows(begin, end)]
        for k in np.sort(random.permutation(len(starts))[:share]):
            codes.append(_cut(all_codes, starts[k]))
            tags.append(_tagged(spans, starts[k]))
    plain = [t[:WINDOW * 4] for t in texts] or ["word " * WINDOW]
    for i in range(max(len(codes), 400)):
        kind, value = _forms(random)[i % 16]
        text = plain[i % len(plain)]
        text = "".join(c for c in text if not c.isdigit() and c not in "@+") or "a " * WINDOW
        at = int(random.integers(0, WINDOW - min(len(value), WINDOW - 1)))
        text = (text * (1 + WINDOW // len(text)))[:at].rstrip() + " " + value + " " + text
        begin = text.index(value, max(0, min(at, len(text)) - 1) if value in text[at - 1:] else 0)
        spans = [(kind, begin, begin + len(value))] if kind else []
        codes.append(_cut(codes_of(text), 0))
        tags.append(_tagged(spans, 0))
    return np.stack(codes), np.stack(tags)


def fitted(docs: DataFrame) -> Tagger:
    """Tagger from a bounded sample of distinct texts, the ones with the least hashes."""
    usable = docs.where(F.regexp_like("text", F.lit("[0-9@]"))).withColumn("h", F.xxhash64("text"))
    # Hashes alone are compared first; only then are the texts of the chosen ones read.
    chosen = [r["h"] for r in usable.select("h").distinct().orderBy("h").limit(
        SAMPLE_DOCUMENTS).collect()]
    sample = usable.where(F.col("h").isin(chosen)).groupBy("h").agg(
        F.min("text").alias("text")).orderBy("h").collect()
    tagger = Tagger(1 + 2 * len(KINDS))
    tagger.train(*training_windows([r["text"] for r in sample]), EPOCHS)
    return tagger


# --- decoding -----------------------------------------------------------------------------------

_EDGE = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(float)


def _allowed(tags: int) -> np.ndarray:
    """0 where a tag may follow another, else minus infinity."""
    moves = np.zeros((tags, tags))
    for k in range(len(KINDS)):
        moves[:, 2 + 2 * k] = -np.inf
        moves[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0
    return moves


_MOVES = _allowed(1 + 2 * len(KINDS))


def decoded(chances: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(kind, begin, end, sureness) along the best path through one stretch."""
    score = np.log(np.maximum(chances, 1e-9))
    best = score[0] + _MOVES[0]
    came = np.zeros(chances.shape, np.int64)
    for t in range(1, len(score)):
        through = best[:, None] + _MOVES
        came[t] = through.argmax(axis=0)
        best = through.max(axis=0) + score[t]
    path = [int(best.argmax())]
    for t in range(len(score) - 1, 0, -1):
        path.append(int(came[t, path[-1]]))
    path.reverse()
    spans, t = [], 0
    while t < len(path):
        if path[t] % 2:
            kind, end = path[t] // 2, t + 1
            while end < len(path) and path[end] == path[t] + 1:
                end += 1
            each = chances[t:end, path[t]] + chances[t:end, path[t] + 1]
            spans.append((kind, t, end, float(each.mean())))
            t = end
        else:
            t += 1
    return spans


def _fits(kind: str, value: str) -> bool:
    digits = _digits(value)
    if kind == "email":
        local, _, domain = value.partition("@")
        return bool(local and "." in domain)
    if kind == "ip":
        return False  # the pattern knows the only form
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15 and any(c in "()-. " for c in value) and value[0] in "+("


def more_spans(tagger: Tagger, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
    """Spans of the tagger that the base does not have, for many texts at once."""
    parts, cuts = [], []  # stretches of all texts, and their windows
    for number, text in enumerate(texts):
        codes = codes_of(text)
        for begin, end in stretches(codes):
            parts.append((number, begin, np.zeros((end - begin, tagger.tags)),
                          np.zeros(end - begin)))
            cuts += [(len(parts) - 1, start - begin, _cut(codes, start))
                     for start in _windows(begin, end)]
    for at in range(0, len(cuts), BATCH):
        some = cuts[at:at + BATCH]
        for (part, start, _), chance in zip(
                some, tagger.marginals(np.stack([c for *_, c in some])), strict=True):
            total, weight = parts[part][2:]
            size = min(WINDOW, len(weight) - start)
            total[start:start + size] += chance[:size] * _EDGE[:size, None]
            weight[start:start + size] += _EDGE[:size]
    out: list[list[Span]] = [[] for _ in texts]
    for number, begin, total, weight in parts:
        chances = total / weight[:, None]
        if chances[:, 0].min() > 0.5:
            continue
        for k, a, b, sure in decoded(chances):
            kind, a, b = KINDS[k], a + begin, b + begin
            while a < b and texts[number][a].isspace():
                a += 1
            while a < b and (texts[number][b - 1].isspace() or texts[number][b - 1] in ".,;"):
                b -= 1
            if (a < b and sure >= SURE and _fits(kind, texts[number][a:b])
                    and all(b <= x or y <= a for _, x, y in base[number])):
                out[number].append((kind, a, b))
    return out


def _written(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in ordered)


def find_personal_data(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """(doc_id, base, spans, n_email, ...): spans as text, of the patterns and of both."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    names = [f"n_{kind}" for kind in KINDS]

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_slices(batch):
                marked = np.append(0, np.cumsum(_TRIGGER[data]))[offsets]
                which = np.flatnonzero(np.diff(marked))
                texts = [data[offsets[i]:offsets[i + 1]].tobytes().decode() for i in which]
                base = [base_spans(text) for text in texts]
                more = more_spans(shared.value, texts, base)
                own, every = [""] * (end - row), [""] * (end - row)
                counts = np.zeros((len(KINDS), end - row), np.int64)
                for i, b, m in zip(which.tolist(), base, more, strict=True):
                    own[i], every[i] = _written(b), _written(b + m)
                    for kind, _, _ in b:
                        counts[KINDS.index(kind), i] += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, end - row), *map(pa.array, counts),
                     pa.array(own), pa.array(every)], ["doc_id", *names, "base", "spans"])

    columns = ", ".join(f"{name} long" for name in names)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        per_partition, f"doc_id long, {columns}, base string, spans string")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", *[f"n_{kind}" for kind in KINDS],
                        F.sha2("base", 256).alias("base_sha256"), "spans")
