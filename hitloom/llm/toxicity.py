"""Toxicity: a linear-chain conditional random field tags toxic spans; its marginals score documents.

Labels exist for documents.  Token labels for training follow from them: a feature
(a word, or its first 4 to 6 letters) that many toxic and almost no clean documents
of the sample have marks the tokens that carry it in toxic documents.  The field
has two states and is trained on those tokens by gradient ascent on its likelihood.
Forward-backward gives each token of a whole text its marginal; the largest one and
their sum give the document's score through a fitted logistic curve, and runs of
tokens with a marginal of at least one half are the offending spans.

Only texts are inputs of a score.  The sample is bounded (``SAMPLE`` labelled rows
of each class, by a hash of their id) and is the only thing that reaches the driver.

Defined results
    null and empty texts have no tokens and get the curve's lowest score; repeated
    rows are scored each; a sample without both classes gives a field that scores 0
    everywhere; an empty table gives an empty result; other columns are carried
    along, and new columns whose names clash get a leading ``_``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.bpe import slices
from hitloom.llm.common import fresh, ship, small_batches, text_or_empty, with_fields, worker_keeps

ship(__name__)

#: Labelled rows of each class that the field is trained on, at most.
SAMPLE = 2000
#: Slots of hashed features; tokens in a training window; words a task remembers; characters handled at a time.
SLOTS, WINDOW, REMEMBERED, CHARS_AT_ONCE = 1 << 18, 32, 400_000, 4_000_000
#: A marking feature: toxic sample documents that have it, and how many times the clean share.
LEAST_DOCS, TIMES_CLEAN = 8, 20.0
WORD = re.compile(r"[^\W_]+")


@dataclass
class Field:
    """Weights of features (toxic against not), of state pairs and of the start, and the document curve."""

    weights: np.ndarray
    pairs: np.ndarray  # log potentials [from, to]
    start: float
    curve: np.ndarray  # of 1, the largest marginal's log odds, log(1 + sum of marginals)


def features(word: str) -> list[str]:
    word = word.lower()
    return [f"w:{word}", *[f"{n}:{word[:n]}" for n in (4, 5, 6) if len(word) >= n]]


def slots(word: str) -> list[int]:
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % SLOTS for f in features(word)]


def _marking(texts: list[list[str]], toxic: np.ndarray) -> set[str]:
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for words, label in zip(texts, toxic):
        seen[int(label)].update({f for w in set(words) for f in features(w)})
    n = (max(1, int((~toxic).sum())), max(1, int(toxic.sum())))
    return {f for f, c in seen[1].items() if c >= LEAST_DOCS and c / n[1] >= TIMES_CLEAN * (seen[0][f] + 0.5) / n[0]}


def _windows(texts, toxic, marking, random) -> tuple[list[list[str]], list[list[int]]]:
    words_out, labels_out = [], []
    carries: dict[str, bool] = {}
    for words, label in zip(texts, toxic):
        if not words:
            continue
        marks = [0] * len(words)
        if label:
            marks = [int(carries[w]) if w in carries else int(carries.setdefault(w, not marking.isdisjoint(features(w)))) for w in words]
            if not any(marks):
                continue
        at = {max(0, i - int(random.integers(WINDOW))) for i in [j for j, m in enumerate(marks) if m][:4]}
        at |= {int(random.integers(max(1, len(words) - WINDOW + 1))) for _ in range(2)}
        for start in sorted(at):
            words_out.append(words[start : start + WINDOW])
            labels_out.append(marks[start : start + WINDOW])
    return words_out, labels_out


def train(texts: list[str], toxic: list[int], epochs: int = 6, seed: int = 1) -> Field:
    """Fit the field and the document curve on labelled texts."""
    random, label = np.random.default_rng(seed), np.array(toxic, bool)
    empty = Field(np.zeros(SLOTS, np.float32), np.zeros((2, 2)), 0.0, np.array([-20.0, 0.0, 0.0]))
    if label.all() or not label.any():
        return empty
    split = [WORD.findall(t or "") for t in texts]
    words, marks = _windows(split, label, _marking(split, label), random)
    if not any(map(any, marks)):
        return empty
    known: dict[str, list[int]] = {}
    weights, pairs, start = np.zeros(SLOTS), np.zeros((2, 2)), 0.0
    g_w, g_p, g_s = np.full(SLOTS, 1e-6), np.full((2, 2), 1e-6), 1e-6
    order = np.arange(len(words))
    for _ in range(epochs):
        random.shuffle(order)
        for at in range(0, len(order), 256):
            chosen = order[at : at + 256]
            n = np.array([len(words[i]) for i in chosen])
            emit = np.zeros((len(chosen), WINDOW))
            rows, cols, slot = [], [], []
            for r, i in enumerate(chosen):
                for c, w in enumerate(words[i]):
                    s = known.get(w) or known.setdefault(w, slots(w))
                    rows += [r] * len(s)
                    cols += [c] * len(s)
                    slot += s
            rows, cols, slot = np.array(rows), np.array(cols), np.array(slot)
            np.add.at(emit, (rows, cols), weights[slot])
            y = np.zeros((len(chosen), WINDOW), np.int64)
            for r, i in enumerate(chosen):
                y[r, : n[r]] = marks[i]
            valid = np.arange(WINDOW) < n[:, None]
            node, edge = _expected(emit, pairs, start, valid)
            diff = np.where(valid, y - node, 0.0)
            gain = np.bincount(slot, diff[rows, cols], SLOTS) - 1e-4 * weights
            both = valid[:, 1:]
            seen = np.array([[((y[:, :-1] == a) & (y[:, 1:] == b) & both).sum() for b in (0, 1)] for a in (0, 1)])
            gain_p, gain_s = seen - edge, float((y[:, 0] - node[:, 0]).sum())
            g_w += gain**2
            g_p += gain_p**2
            g_s += gain_s**2
            weights += 0.5 * gain / np.sqrt(g_w)
            pairs += 0.2 * gain_p / np.sqrt(g_p)
            start += 0.2 * gain_s / np.sqrt(g_s)
    field = Field(weights.astype(np.float32), pairs, start, np.zeros(3))
    x = np.array([_summary(m) for m in marginals([emissions(w, field, {}) for w in split], field)])
    field.curve = _logistic(x, label.astype(float))
    return field


def _expected(emit, pairs, start, valid):
    """Marginals of the toxic state, and expected counts of state pairs, by forward-backward over padded windows."""
    rows, width = emit.shape
    forward, backward = np.zeros((rows, width, 2)), np.zeros((rows, width, 2))
    potential = np.stack([np.zeros_like(emit), emit], 2)
    forward[:, 0] = potential[:, 0] + np.array([0.0, start])
    step = lambda left, right: np.logaddexp(left, right)
    for t in range(1, width):
        to = [step(forward[:, t - 1, 0] + pairs[0, s], forward[:, t - 1, 1] + pairs[1, s]) + potential[:, t, s] for s in (0, 1)]
        forward[:, t] = np.where(valid[:, t, None], np.stack(to, 1), forward[:, t - 1])
    for t in range(width - 2, -1, -1):
        out = [step(pairs[s, 0] + potential[:, t + 1, 0] + backward[:, t + 1, 0], pairs[s, 1] + potential[:, t + 1, 1] + backward[:, t + 1, 1]) for s in (0, 1)]
        backward[:, t] = np.where(valid[:, t + 1, None], np.stack(out, 1), 0.0)
    total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
    node = np.where(valid, np.exp(np.minimum(forward[:, :, 1] + backward[:, :, 1] - total[:, None], 0)), 0)
    edge = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            log = forward[:, :-1, a] + pairs[a, b] + potential[:, 1:, b] + backward[:, 1:, b] - total[:, None]
            edge[a, b] = np.exp(np.minimum(log, 0))[valid[:, 1:]].sum()
    return node, edge


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Newton's method on the regularised logistic likelihood; columns of x after a constant."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - 1e-2 * w
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), slope)
    return w


def emissions(words: list[str], field: Field, known: dict[str, float]) -> np.ndarray:
    """The weight of the toxic state for each word."""
    try:
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))
    except KeyError:
        if len(known) > REMEMBERED:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = float(np.clip(field.weights[slots(w)].sum(), -30, 30))
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))


def marginals(emits: list[np.ndarray], field: Field) -> list[np.ndarray]:
    """Toxic marginals of every token: forward-backward as odds, all texts a step at a time."""
    lengths = np.array([len(e) for e in emits], np.int64)
    order = np.argsort(-lengths, kind="stable")
    flat = np.exp(np.concatenate([emits[i] for i in order])) if len(emits) and lengths.any() else np.zeros(0)
    ordered = lengths[order]
    starts = np.concatenate([[0], np.cumsum(ordered)[:-1]]) if len(ordered) else np.zeros(0, np.int64)
    # how many texts have more than t tokens
    active = len(ordered) - np.searchsorted(ordered[::-1], np.arange(ordered[0] if len(ordered) else 0), "right")
    (oo, ot), (to, tt) = np.exp(field.pairs)
    ahead, behind = np.empty_like(flat), np.empty_like(flat)
    odds = np.zeros(0)
    for t, k in enumerate(active.tolist()):
        at = starts[:k] + t
        odds = flat[at] * (np.exp(field.start) if t == 0 else (ot + tt * odds[:k]) / (oo + to * odds[:k]))
        ahead[at] = odds
    odds, before = np.zeros(0), 0
    for t in range(len(active) - 1, -1, -1):
        k = int(active[t])
        at = starts[:k] + t
        now = np.ones(k)
        if before:
            x = flat[at[:before] + 1] * odds
            now[:before] = (to + tt * x) / (oo + ot * x)
        behind[at] = now
        odds, before = now, k
    both = ahead * behind
    found = both / (1 + both)
    out: list[np.ndarray] = [np.zeros(0)] * len(emits)
    for place, i in enumerate(order.tolist()):
        out[i] = found[starts[place] : starts[place] + ordered[place]]
    return out


def _summary(m: np.ndarray) -> tuple[float, float]:
    top = float(np.clip(m.max(), 1e-9, 1 - 1e-9)) if len(m) else 1e-9
    return float(np.log(top / (1 - top))), float(np.log1p(m[m > 0.01].sum()))


def _spans(text: str, m: np.ndarray) -> list[dict]:
    """Runs of tokens with a marginal of at least one half, as offsets in characters."""
    spans: list[dict] = []
    before = False
    for token, p in zip(WORD.finditer(text), m.tolist()):
        if p >= 0.5:
            if before:
                spans[-1]["end"], spans[-1]["p"] = token.end(), max(p, spans[-1]["p"])
            else:
                spans.append({"start": token.start(), "end": token.end(), "p": p})
        before = p >= 0.5
    return spans


def held_out(id_column: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text, mod 5, is 0."""
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(5)) == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Field:
    """Train on at most ``sample`` labelled rows of each class that are not held out."""
    name = F.col(f"`{id_col}`")
    usable = labels.where(name.isNotNull() & F.col(label_col).isNotNull() & ~held_out(name))
    usable = usable.groupBy(name.alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    chosen = [
        usable.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(sample) for value in (0, 1)
    ]
    bounded = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 x sample ids and labels
    rows = docs.select(name.alias("id"), text_or_empty(text_col).alias("text")).join(bounded, "id")
    rows = sorted(rows.groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label")).collect(), key=lambda r: r["id"])
    return train([r["text"] for r in rows], [r["label"] for r in rows])


def score(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1), predicted (0 or 1) and spans (array of start, end, p)."""
    out = fresh(docs, "score", "predicted", "spans")
    (text,) = fresh(docs.select("*", *[F.lit(0).alias(c) for c in out]), "text_in")
    columns = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        known = worker_keeps("emissions", hash(field.weights.tobytes()), dict)
        for whole in batches:
            for batch in slices(whole, pc.utf8_length(whole.column(text)).to_numpy(zero_copy_only=False), CHARS_AT_ONCE):
                texts = batch.column(text).to_pylist()
                found = marginals([emissions(WORD.findall(t), field, known) for t in texts], field)
                x = np.array([(1.0, *_summary(m)) for m in found]).reshape(-1, 3)
                scores = 1 / (1 + np.exp(-np.clip(x @ field.curve, -30, 30)))
                spans = [_spans(t, m) if len(m) and m.max() >= 0.5 else [] for t, m in zip(texts, found)]
                arrays = [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), pa.array(spans, kind)]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], *arrays], names=[*columns, *out])

    schema = with_fields(docs, **dict(zip(out, ("double", "int", "array<struct<start: int, end: int, p: double>>"))))
    return small_batches(docs.withColumn(text, text_or_empty(text_col))).mapInArrow(run, schema)
