"""BPE encoding and decoding with a public word-end vocabulary, by a pair occurrence index.

A task splits its texts, gathers the words it has not met, and merges them all
together: an index maps each adjacent pair to every position in those words where
it stands; pairs with a merge are applied in ascending rank, and each merge updates
the position lists of the pairs it removes and creates.  That order is exact
because no merge's parts are made by a later merge, which is checked on loading.

Defined results
    null texts count as empty and give no ids; decoding skips null ids and ids
    outside the vocabulary; texts of any length are encoded whole; repeated rows
    each get their ids; an empty table gives an empty result; other columns are
    carried along, and new columns whose names clash get a leading ``_``.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import fresh, ship, small_batches, text_or_empty, with_fields, worker_keeps

ship(__name__)

#: Tokens of text that a task remembers, and characters of text it splits at a time: bounds of its memory.
REMEMBERED, CHARS_AT_ONCE = 500_000, 250_000
#: Rows handed to Python at a time.
BATCH_ROWS = 250
_ODD_SPACE = re.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (c for c in range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class WordBpe:
    """Vocabulary, merges and splitting rule of a tokenizer file, with a bounded memory of encoded tokens."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        pattern = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        letters = byte_letters()
        self.letters = np.array([vocab[c] for c in letters] + [vocab[c + self.suffix] for c in letters])  # bytes, then last bytes
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.letter_ranks = np.full((512, 512), -1, np.int32)  # of the pairs of bytes
        at = {int(token): i for i, token in enumerate(self.letters)}
        for (a, b), (rank, _) in self.merges.items():
            if a in at and b in at:
                self.letter_ranks[at[a], at[b]] = rank
        made: dict[int, int] = {}
        for rank, token in self.merges.values():
            made[token] = max(rank, made.get(token, -1))
        if any(max(made.get(a, -1), made.get(b, -1)) > rank for (a, b), (rank, _) in self.merges.items()):
            raise ValueError("a merge uses a token that a later merge makes; ascending ranks would not be exact")
        self.of_rank = {rank: (pair, token) for pair, (rank, token) in self.merges.items()}
        self.known: dict[str, bytes] = {}  # ids of 4 bytes

    def merge_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, 4 bytes each: all words merged together through one pair occurrence index."""
        if not words:
            return []
        raws = [word.encode("utf-8") for word in words]
        sizes = np.fromiter(map(len, raws), np.int64, len(raws))
        stops = np.cumsum(sizes + 1) - 1  # no merge reaches over a word's end
        raw = np.frombuffer(b"\0".join(raws) + b"\0", np.uint8).astype(np.int64)
        raw[stops - 1] += 256  # the last byte of a word
        letters = self.letters.take(raw)
        letters[stops] = -1
        symbols, starts, n = letters.tolist(), (stops - sizes).tolist(), len(letters)
        ranks = self.letter_ranks[raw[:-1], raw[1:]]
        ranks[stops[:-1]] = ranks[stops - 1] = -1
        places = np.flatnonzero(ranks >= 0)
        places = places[np.argsort(ranks[places], kind="stable")]
        ranks = ranks[places]
        cuts = np.flatnonzero(np.diff(ranks, prepend=-1))
        at_rank = {r: i.tolist() for r, i in zip(ranks[cuts].tolist(), np.split(places, cuts[1:]))} if len(cuts) else {}
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        merges = self.merges
        active = list(at_rank)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            (a, b), token = self.of_rank[rank]
            places = at_rank.pop(rank)
            places.sort()
            for i in places:
                j = after[i]
                if symbols[i] != a or j >= n or symbols[j] != b:
                    continue
                symbols[i], symbols[j] = token, -2
                k = after[j]
                after[i] = k
                if k < n:
                    before[k] = i
                    rule = merges.get((token, symbols[k]))
                    if rule:
                        if rule[0] not in at_rank:
                            at_rank[rule[0]] = []
                            heapq.heappush(active, rule[0])
                        at_rank[rule[0]].append(i)
                h = before[i]
                if h >= 0:
                    rule = merges.get((symbols[h], token))
                    if rule:
                        if rule[0] not in at_rank:
                            at_rank[rule[0]] = []
                            heapq.heappush(active, rule[0])
                        at_rank[rule[0]].append(h)
        return [array("i", [s for s in symbols[start:end] if s >= 0]).tobytes() for start, end in zip(starts, [*starts[1:], n])]

    def split(self, text: str) -> list[str]:
        """Tokens between white space; the vocabulary's own split never reaches over white space."""
        return regex.split(r"\s+", text) if _ODD_SPACE.search(text) else text.split()

    def learn(self, tokens: Iterable[str]) -> dict[str, bytes]:
        """Encode tokens not yet known; returns the memory."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        missing = [t for t in set(tokens) if t not in self.known]
        if not missing:
            return self.known
        parts: list[list[str | int]] = []
        for token in missing:
            mine: list[str | int] = []
            for piece in self.cut(token) if self.cut and "<" in token else (token,):
                if piece in self.special:
                    mine.append(self.special[piece])
                elif piece:
                    plain = piece if piece.isascii() else unicodedata.normalize("NFC", piece).replace("Σ", "σ")
                    mine.extend(self.pieces(plain.lower()))
            parts.append(mine)
        words = list({w for mine in parts for w in mine if isinstance(w, str) and w not in self.known})
        known = self.known
        known.update(zip(words, self.merge_words(words)))  # a piece alone is a token with the same ids
        for token, mine in zip(missing, parts):
            known[token] = b"".join([known[w] if isinstance(w, str) else array("i", [w]).tobytes() for w in mine])
        return known

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, words of up to CHARS_AT_ONCE characters at a time."""
        out: list[np.ndarray] = []
        held: list[list[str]] = []
        size = 0

        def flush() -> None:
            known = self.learn(chain.from_iterable(held))
            out.extend([np.frombuffer(b"".join(map(known.__getitem__, tokens)), np.int32) for tokens in held])
            held.clear()

        for text in texts:
            if size and size + len(text) > CHARS_AT_ONCE:
                flush()
                size = 0
            held.append(self.split(text))
            size += len(text)
        flush()
        return out


def loaded(spec: str) -> WordBpe:
    """The tokenizer of this Python worker, kept between its tasks."""
    return worker_keeps("bpe", spec, lambda: WordBpe(spec))


def token_list(spec: str) -> list[str | None]:
    """The token of each id of a tokenizer file, its special tokens included."""
    data = json.loads(spec)
    ids = [*data["model"]["vocab"].items(), *((t["content"], t["id"]) for t in data["added_tokens"])]
    tokens: list[str | None] = [None] * (max(i for _, i in ids) + 1)
    for token, i in ids:
        tokens[i] = token
    return tokens


def read_spec(path: str) -> str:
    """A tokenizer file as text, read on the driver: about 2 MB, sent with the tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def slices(batch: pa.RecordBatch, sizes: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` of ``sizes`` in all."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


Batches = Iterator[pa.RecordBatch]


def _encoding(columns: list[str], text: str, name: str, spec: Broadcast) -> Callable[[Batches], Batches]:
    """The task that adds ids ``name`` of ``text`` to ``columns``."""

    def run(batches: Batches) -> Batches:
        bpe = loaded(spec.value)
        for whole in batches:
            for batch in slices(whole, pc.utf8_length(whole.column(text)).to_numpy(zero_copy_only=False), CHARS_AT_ONCE):
                ids = bpe.encode(batch.column(text).to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate(ids)
                found = pa.ListArray.from_arrays(offsets, flat)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], found], names=[*columns, name])

    return run


def _decoding(columns: list[str], ids_col: str, name: str, shared: Broadcast) -> Callable[[Batches], Batches]:
    """The task that adds the text ``name`` of ``ids_col`` to ``columns``."""

    def run(batches: Batches) -> Batches:
        tokens = pa.array(shared.value, pa.large_string())
        for whole in batches:
            sizes = pc.fill_null(pc.list_value_length(whole.column(ids_col)), 0).to_numpy(zero_copy_only=False)
            for batch in slices(whole, sizes, CHARS_AT_ONCE):
                ids = pc.fill_null(batch.column(ids_col).cast(pa.list_(pa.int64())), pa.scalar([], pa.list_(pa.int64())))
                flat, owner = ids.flatten(), pc.list_parent_indices(ids)
                good = pc.fill_null(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(tokens))), False)
                words, owner = tokens.take(flat.filter(good)), owner.filter(good)
                good = words.is_valid()
                words, owner = words.filter(good), owner.filter(good).to_numpy(zero_copy_only=False)
                offsets = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int64)
                text = pc.binary_join(pa.LargeListArray.from_arrays(offsets, words), pa.scalar(" ", pa.large_string()))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], text.cast(pa.string())], names=[*columns, name])

    return run


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of the whole text of each row (array<int>)."""
    name, text = fresh(docs, ids_col, "text_in")
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(vocabulary))
    given = small_batches(docs.withColumn(text, text_or_empty(text_col)), BATCH_ROWS)
    return given.mapInArrow(_encoding(docs.columns, text, name, spec), with_fields(docs, **{name: "array<int>"}))


def decode(rows: DataFrame, vocabulary: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids: without a decoder in the vocabulary, tokens joined by one space."""
    (name,) = fresh(rows, text_col)
    tokens = rows.sparkSession.sparkContext.broadcast(token_list(read_spec(vocabulary)))  # one string per id
    given = small_batches(rows, BATCH_ROWS)
    return given.mapInArrow(_decoding(rows.columns, ids_col, name, tokens), with_fields(rows, **{name: "string"}))


def round_trip(
    docs: DataFrame, vocabulary: str, text_col: str = "text", keep: list[str] | None = None, ids_col: str = "ids", decoded_col: str = "decoded"
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default), their ids, and the text that those ids decode to.

    The same as :func:`decode` of :func:`encode`, by one Python worker a task instead of two:
    ids go from the one to the other in the worker, and the JVM sees neither the text again
    nor the ids twice.
    """
    columns = docs.columns if keep is None else keep
    kept = docs.select(*[f"`{c}`" for c in columns])
    ids, decoded, text = fresh(kept, ids_col, decoded_col, "text_in")
    context, spec = docs.sparkSession.sparkContext, read_spec(vocabulary)
    encoding = _encoding(columns, text, ids, context.broadcast(spec))
    decoding = _decoding([*columns, ids], ids, decoded, context.broadcast(token_list(spec)))
    given = small_batches(docs.select(*[f"`{c}`" for c in columns], text_or_empty(text_col).alias(text)), BATCH_ROWS)
    schema = with_fields(kept, **{ids: "array<int>", decoded: "string"})
    return given.mapInArrow(lambda batches: decoding(encoding(batches)), schema)


def digests(rows: DataFrame, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with n_tokens and the SHA-256 of the ids (decimal, joined by one space) and of the text."""
    ids = F.col(f"`{ids_col}`")
    return rows.withColumns({
        "n_tokens": F.size(ids).cast("long"),
        "ids_sha256": F.sha2(F.array_join(ids.cast("array<string>"), " "), 256),
        "decoded_sha256": F.sha2(F.col(f"`{text_col}`"), 256),
    })
