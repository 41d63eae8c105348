"""Secret scan: fixed patterns, and tokens that a battery of randomness tests takes for random.

Base spans come from three patterns.  The battery judges every token (a run of at
least ``CLASSES[0]`` letters, digits, ``+ / _ -``, with up to two ``=`` behind it):

* the *encoding* is the smallest alphabet that holds all its symbols (hex, base 32,
  base 36, base 62, base 64 and the URL form); tokens of digits alone are no candidates;
* three tests of the symbols' places in that alphabet: chi-squared uniformity over
  cells with five symbols or more expected, the runs test above and below the middle,
  and the lag-1 serial correlation; the score is the largest of the three deviations;
* *length-aware false-discovery control*: ordinary text of the corpus, its letters and
  digits run together and cut into blocks of each class length, goes through the same
  battery.  Its share that reaches an encoding with at most some score is the chance
  that ordinary text looks so random at that length.  In each class and encoding the
  largest score is taken at which expected false finds stay below ``rate`` of all finds.
  Tokens that the battery itself rejects (beyond ``REJECT``) are never reported.

All texts are read once.  Candidates and block counts are stored; the counts met by the
driver are at most classes x encodings x bins.

Defined results
    null and empty texts have no spans (the digest is that of the empty string); whole
    texts are scanned, whatever their length; repeated rows each get their spans; an
    empty table gives an empty result; where the corpus has too little text to bound
    false finds, no token is added.  Starts and ends are code points, ends exclusive.
    Working columns take names that no column of the table has.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import fresh, ship, store, with_fields

ship(__name__)

# The base patterns.  Quantifiers carry the least length, as a run that is too short holds no longer one.
ASSIGN = r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

TOKEN = r"[A-Za-z0-9+/_-]{16,}={0,2}"
#: Length classes by their least length; ordinary text is cut into blocks of these lengths.
CLASSES = (16, 20, 24, 32, 48, 64, 128)
#: Scores are binned by quarters of a standard deviation.
BINS, PER_BIN = 64, 4
#: The battery rejects a token beyond this deviation (about one random token in a hundred over three tests).
REJECT = 2.75

_GROUPS = ("0189", "234567", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+/", "-_")
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets from small to large; the first that holds all symbols of a token is its encoding.
ENCODINGS = {
    "decimal": _DIGITS, "hex": _DIGITS + "abcdef", "hex upper": _DIGITS + "ABCDEF", "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER, "base36 upper": _DIGITS + _UPPER, "base62": _DIGITS + _UPPER + _LOWER,
    "base64": _DIGITS + _UPPER + _LOWER + "+/", "base64url": _DIGITS + _UPPER + _LOWER + "-_",
    "any": _DIGITS + _UPPER + _LOWER + "+/-_",
}
_SIZES = [len(a) for a in ENCODINGS.values()]


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bits of the groups that a byte is in; the encoding of a set of groups; a byte's place in each alphabet."""
    bits = np.zeros(256, np.uint8)
    for i, group in enumerate(_GROUPS):
        bits[list(group.encode())] = 1 << i
    places = np.zeros((len(ENCODINGS), 256), np.uint8)
    encoding = np.zeros(256, np.int64)
    holds = []
    for i, alphabet in enumerate(ENCODINGS.values()):
        raw = list(alphabet.encode())
        places[i, raw] = np.arange(len(raw))
        holds.append(int(np.bitwise_or.reduce(bits[raw])))
    for groups in range(256):
        encoding[groups] = next(i for i, h in enumerate(holds) if groups & ~h == 0)
    return bits, encoding, places


_BITS, _ENCODING, _PLACES = _tables()


def deviations(places: np.ndarray, size: int) -> np.ndarray:
    """The largest deviation of the three tests for each row of ``places`` (rows of one length, alphabet of ``size``)."""
    rows, n = places.shape
    v = places.astype(np.int64)
    cells = min(size, max(2, n // 5))
    cell = v * cells // size
    seen = np.bincount((np.arange(rows)[:, None] * cells + cell).ravel(), minlength=rows * cells).reshape(rows, cells)
    expected = np.bincount(np.arange(size) * cells // size, minlength=cells) * (n / size)
    chi = ((seen - expected) ** 2 / expected).sum(1)
    free = cells - 1
    # The cube root of a chi-squared variable is close to normal.
    uniformity = (np.cbrt(chi / free) - (1 - 2 / (9 * free))) / np.sqrt(2 / (9 * free))
    high = v >= size / 2
    ups = high.sum(1).astype(float)
    mean = 2 * ups * (n - ups) / n
    runs = (high[:, 1:] != high[:, :-1]).sum(1)
    spread = mean * (mean - 1) / (n - 1)
    worst = BINS / PER_BIN
    runs_z = np.where(spread > 0, np.abs(runs - mean) / np.sqrt(np.where(spread > 0, spread, 1)), worst)
    centred = v - v.mean(1, keepdims=True)
    power = (centred**2).sum(1)
    lag = (centred[:, 1:] * centred[:, :-1]).sum(1) / np.where(power > 0, power, 1)
    serial_z = np.where(power > 0, np.abs(lag + 1 / n) * np.sqrt(n), worst)
    return np.maximum(np.maximum(uniformity, 0), np.maximum(runs_z, serial_z))


def battery(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Encoding and deviation of each row of ``symbols`` (ASCII bytes, rows of one length)."""
    kind = _ENCODING[np.bitwise_or.reduce(_BITS[symbols], axis=1)]
    found = np.full(len(symbols), BINS / PER_BIN)
    for i in np.unique(kind):
        if i:  # digits alone are counted, never scored
            own = kind == i
            found[own] = deviations(_PLACES[i][symbols[own]], _SIZES[i])
    return kind, found


def _bins(deviation: np.ndarray) -> np.ndarray:
    return np.minimum((deviation * PER_BIN).astype(np.int64), BINS - 1)


def _cell(length_class: int, kind: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return (length_class * len(ENCODINGS) + kind) * BINS + bins


_CELLS = len(CLASSES) * len(ENCODINGS) * BINS
_CYCLE = sum(CLASSES)


def blocks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ordinary text cut into blocks of the class lengths in turn: one array for each class."""
    whole = len(symbols) // _CYCLE
    body, rest = symbols[: whole * _CYCLE].reshape(whole, _CYCLE), symbols[whole * _CYCLE :]
    out, at = [], 0
    for length in CLASSES:
        part = body[:, at : at + length]
        if len(rest) >= at + length:
            part = np.concatenate([part, rest[None, at : at + length]])
        out.append(part)
        at += length
    return out


_assign, _access, _hex, _token = (re.compile(p) for p in (ASSIGN, ACCESS, HEX, TOKEN))
_ALNUM = np.isin(np.arange(256), list((_DIGITS + _LOWER + _UPPER).encode()))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start, then kind as listed."""
    found = [(m.start(), m.end(), "assign") for m in _assign.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LEAST]
    found += [(m.start(), m.end(), "access") for m in _access.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in _hex.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _class_of(length: int) -> int:
    return sum(length >= least for least in CLASSES) - 1


def judge(texts: list[str]) -> tuple[list[list[tuple[int, int, str]]], list[list[tuple[int, int, int]]], np.ndarray]:
    """Base spans of each text, (start, end, cell) of its other tokens, and the cells of its ordinary text."""
    base, tokens = [], []
    ordinary: list[list[np.ndarray]] = [[] for _ in CLASSES]
    by_length: dict[int, list[tuple[int, int, bytes]]] = {}
    for i, text in enumerate(texts):
        spans = base_spans(text)
        base.append(spans)
        tokens.append([])
        plain, at = [], 0
        for m in _token.finditer(text):
            plain.append(text[at : m.start()])
            at = m.end()
            raw = m.group().rstrip("=").encode()
            by_length.setdefault(len(raw), []).append((i, len(tokens[i]), raw))
            inside = any(s <= m.start() and m.end() <= e for s, e, _ in spans)
            tokens[i].append((m.start(), m.end(), -2 if inside else -1))
        plain.append(text[at:])
        symbols = np.frombuffer("".join(plain).encode("utf-8", "replace"), np.uint8)
        for c, part in enumerate(blocks(symbols[_ALNUM[symbols]])):
            ordinary[c].append(part)
    for length, members in by_length.items():
        rows = np.frombuffer(b"".join(raw for *_, raw in members), np.uint8).reshape(len(members), length)
        kind, deviation = battery(rows)
        cells = np.where((kind > 0) & (deviation <= REJECT), _cell(_class_of(length), kind, _bins(deviation)), -1)
        # A rejected token still counts as a candidate of its class: the last bin of decimal stands for it.
        cells = np.where(cells < 0, _cell(_class_of(length), 0, BINS - 1), cells)
        for (i, j, _), cell in zip(members, cells.tolist()):
            start, end, mark = tokens[i][j]
            tokens[i][j] = (start, end, cell if mark == -1 else -1)
    counts = np.zeros(_CELLS, np.int64)
    for c, parts in enumerate(ordinary):
        rows = np.concatenate(parts) if parts else np.zeros((0, CLASSES[c]), np.uint8)
        if len(rows):
            kind, deviation = battery(rows)
            counts += np.bincount(_cell(c, kind, _bins(deviation)), minlength=_CELLS)
    return base, [[t for t in row if t[2] >= 0] for row in tokens], counts


def thresholds(candidates: dict[int, int], ordinary: dict[int, int], rate: float) -> list[int]:
    """For each class and encoding the largest bin that is reported (-1: none)."""
    def table(counts: dict[int, int]) -> np.ndarray:
        flat = np.zeros(_CELLS, np.int64)
        for cell, n in counts.items():
            flat[cell] = n
        return flat.reshape(len(CLASSES), len(ENCODINGS), BINS)

    tokens, plain = table(candidates), table(ordinary)
    family = tokens.sum((1, 2))[:, None, None]
    chance = (1 + plain.cumsum(2)) / (1 + plain.sum((1, 2))[:, None, None])
    finds = tokens.cumsum(2)
    good = (finds > 0) & (family * chance <= rate * finds)
    good[:, 0] = False
    best = np.where(good.any(2), BINS - 1 - good[:, :, ::-1].argmax(2), -1)
    return best.ravel().tolist()


def _slices(batch: pa.RecordBatch, column: str, most_rows: int = 500, most_bytes: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with few rows and bytes of text; a longer text stands alone."""
    sizes = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(column)])
    at = 0
    while at < batch.num_rows:
        ends = np.searchsorted(np.cumsum(sizes[at : at + most_rows]), most_bytes, side="right")
        rows = max(1, int(ends))
        yield batch.slice(at, rows)
        at += rows


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
_TOKENS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cell", pa.int32())]))
_COUNTS = pa.list_(pa.struct([("cell", pa.int32()), ("n", pa.int64())]))


def _structs(kind: pa.ListType, rows: list) -> pa.Array:
    names = [kind.value_type.field(i).name for i in range(kind.value_type.num_fields)]
    return pa.array([[dict(zip(names, x)) for x in row] for row in rows], kind)


def scan(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] | None = None, rate: float = 0.01) -> DataFrame:
    """``keep`` (all columns but the text, if not given) with the spans of every row's text.

    Adds ``n_assign``, ``n_access``, ``n_hex`` and ``n_random``, the array ``secrets`` of
    (start, end, kind), ``base_sha256`` and ``spans`` (names that clash get a leading ``_``).
    """
    columns = [c for c in docs.columns if c != text_col] if keep is None else list(keep)
    kept = docs.select(*[F.col(f"`{c}`") for c in columns])
    base, tokens, counts, text = fresh(kept, "base", "tokens", "ordinary", "text_in")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, text):
                spans, others, ordinary = judge(part.column(text).to_pylist())
                full = np.flatnonzero(ordinary)
                sums = [list(zip(full.tolist(), ordinary[full].tolist()))] + [[]] * (part.num_rows - 1)
                arrays = [_structs(_SPANS, spans), _structs(_TOKENS, others), _structs(_COUNTS, sums)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], *arrays], names=[*columns, base, tokens, counts])

    schema = with_fields(kept, **{
        base: "array<struct<start:int,end:int,kind:string>>", tokens: "array<struct<start:int,end:int,cell:int>>",
        counts: "array<struct<cell:int,n:bigint>>",
    })
    given = docs.select(*kept.columns, F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias(text))
    judged = store(given.mapInArrow(run, schema), "secrets")

    def sums(column: str, n: F.Column) -> dict[int, int]:
        """At most one row for each cell."""
        cells = judged.select(F.explode(column).alias("x")).groupBy(F.col("x.cell").alias("cell")).agg(F.sum(n).alias("n"))
        return {r.cell: r.n for r in cells.collect()}

    best = thresholds(sums(tokens, F.lit(1)), sums(counts, F.col("x.n")), rate)
    random = F.expr(
        f"transform(filter(`{tokens}`, t -> pmod(t.cell, {BINS}) <= get(array({', '.join(map(str, best))}), int(t.cell div {BINS}))), "
        "t -> named_struct('start', t.start, 'end', t.end, 'kind', 'random'))"
    ) if any(b >= 0 for b in best) else F.expr("cast(array() as array<struct<start:int,end:int,kind:string>>)")
    out = fresh(kept, "n_assign", "n_access", "n_hex", "n_random", "secrets", "base_sha256", "spans")
    order = " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS))

    def joined(spans: str) -> F.Column:
        return F.expr(
            f"array_join(transform(array_sort(transform({spans}, s -> named_struct('start', s.start, 'rank', CASE s.kind {order} END, "
            "'text', concat(s.kind, ':', s.start, ':', s.end)))), s -> s.text), ',')"
        )

    found = judged.withColumn(out[4], F.concat(F.col(f"`{base}`"), random))
    count = lambda kind: F.size(F.filter(F.col(f"`{out[4]}`"), lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        *[F.col(f"`{c}`") for c in columns], *[count(kind).alias(name) for kind, name in zip(KINDS, out)],
        F.col(f"`{out[4]}`"), F.sha2(joined(f"`{base}`"), 256).alias(out[5]), joined(f"`{out[4]}`").alias(out[6]),
    )


def digest(spans: list[tuple[int, int, str]]) -> str:
    return hashlib.sha256(written(spans).encode()).hexdigest()
