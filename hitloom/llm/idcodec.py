"""Token-id output: an adaptive context-mixing range coder over independently reset blocks.

Texts are encoded with a public tokenizer, an end id is appended to each, and the
ids of a range of documents form one stream that is cut into blocks.  In a block,
the last two ids and the last id each predict one next id, with a confidence; a
mixture whose weights adapt to how often predictions of that confidence were right
gives the intervals "as order 2 says", "as order 1 says" and "any other id".  The
last one is order 0: ids are put into classes by how often the block has them, a class
has a share that adapts to its use, and the ids of a class have equal shares of it.
The intervals drive a range coder.  Predictions are learned at every id, the weights
every ``REFRESH`` ids and the shares of classes every ``CLASS_REFRESH``.  Each block
resets all of this and carries the CRC-32 of its ids.

numpy codes one id of many blocks in a step, so a step's cost is shared by all blocks
of several segments; what does not wait for the step before is done for ``REFRESH``
steps at once.

File format: a folder of Parquet files, written by Spark so that remote stores, task
retries and lost executors are its committer's work.  A row is a segment: whole
documents in ascending id order, about ``SEGMENT_IDS`` ids, in (part, seq) order.
    part, seq     place of the segment
    doc_ids       ids of its documents;  lengths: their numbers of token ids
    payload       number of blocks (u32), length of each (u32), then the blocks
A block (little endian): ids (u32), alphabet size (u32), alphabet bytes (u32), code
words (u32), CRC-32 of its ids as u32 (u32); as LEB128 the number of classes, their
sizes and the differences of the sorted ids of each class, from 0; the code words (u32).

Defined results
    null texts count as empty: the end id alone; null document ids come first, in the
    order of their texts' hashes, as do repeated ids among themselves; an empty table
    gives files without rows; other columns are not stored; a damaged block raises.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitloom.llm.bpe import read_spec, slices
from hitloom.llm.common import ship, small_batches, store, text_or_empty, worker_keeps

ship(__name__)

#: Ids in a block and, about, in a segment; segments and characters handled at a time; words and other pieces a worker remembers.
BLOCK_IDS, SEGMENT_IDS, SEGMENTS_AT_ONCE, CHARS_AT_ONCE, REMEMBERED = 4096, 1 << 19, 16, 2_000_000, 1_000_000

# Fixed values of the coder; files depend on them.
SLOT_BITS, CLASS_BITS, PAIR_SLOTS, REFRESH, CLASS_REFRESH, GAIN = 16, 10, 2048, 128, 512, 2
CLASSES, CONTEXTS = 32, 32
_HIT2, _HIT1, _OTHER = 0, 1, 2  # as order 2 says, as order 1 says, any other id
_NONE = CLASSES - 1  # the class of ids that order 2 or order 1 gives
_LEAST, _SPARE, _AGED = 64, 256, 255
_ODD_SPACE = re.compile("[\x1c-\x1f]")  # white space to str.split, not to the library
#: Letters and signs, two pieces to the library's split, whatever stands around them; composing changes neither.
_WORD = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<signs>[!\"#$%&()*+,\-./:;=>?@\[\\\]^_`{|}~]*)$"
_LETTERS_APART = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_WIDEST, _NARROW, _REST, _32, _24, _8 = np.uint64(1 << 56), np.uint64(1 << 24), np.uint64((1 << 24) - 1), np.uint64(32), np.uint64(24), np.uint64(8)
_SLOT, _CLASS = np.uint64(SLOT_BITS), np.uint64(CLASS_BITS)
_HEAD = "<IIIII"


class _Model:
    """The adaptive state of many blocks: flat tables, in which block i has the i-th stretch.

    ``held`` has what followed an id, counted from 1 (0: the block's start), and then what
    followed a pair of ids, hashed: (id + 1) * 4 + confidence, 0 where there is no prediction.
    The ids of a block are numbered by class; the weights of the mixture and of the classes
    stay as they are between refreshes.
    """

    def __init__(self, sizes: np.ndarray, used: np.ndarray):
        blocks, step = len(sizes), int(sizes.sum(axis=1).max()) + 1
        rows = np.arange(blocks)
        self.at_first, self.at_second = rows * step, rows * PAIR_SLOTS + blocks * step
        self.at_context, self.at_class, self.at_slot = rows * CONTEXTS, rows * CLASSES, rows << CLASS_BITS
        self.held = np.zeros(blocks * (step + PAIR_SLOTS), np.uint16 if step < 1 << 14 else np.int32)
        self.told = np.repeat(np.array([[1], [1], [6]], np.int64), blocks * CONTEXTS, axis=1)  # by kind, then block and context
        self.present, self.used = sizes > 0, used.astype(np.int64)
        self.first_of = (np.cumsum(sizes, axis=1) - sizes).ravel()
        self.size_of = np.maximum(sizes, 1).astype(np.uint64)
        self.size_of[:, _NONE] = 1
        self.size_of = self.size_of.ravel()
        self.weigh()
        self.weigh_classes()

    def weigh(self) -> None:
        """Interval ends of order 2 and order 1 in each context, from how often they were right."""
        room = ((1 << SLOT_BITS) - _SPARE - 2 * _LEAST) / (self.told[_HIT2] + self.told[_HIT1] + self.told[_OTHER])
        self.end2 = (self.told[_HIT2] * room).astype(np.uint64) + np.uint64(_LEAST)
        self.end1 = (self.told[_HIT1] * room).astype(np.uint64) + self.end2 + np.uint64(_LEAST)

    def weigh_classes(self) -> None:
        total = np.maximum(self.used.sum(axis=1), 1)
        spread = (1 << CLASS_BITS) - self.present.sum(axis=1)
        width = self.present * (1 + self.used * spread[:, None] // total[:, None])
        width[np.arange(len(width)), width.argmax(axis=1)] += (1 << CLASS_BITS) - width.sum(axis=1)
        self.class_at = np.repeat(np.tile(np.arange(CLASSES, dtype=np.uint8), len(width)), width.ravel())
        low = np.cumsum(width, axis=1) - width
        low[:, _NONE], width[:, _NONE] = 0, 1 << CLASS_BITS
        self.class_low, self.class_width = low.astype(np.uint64).ravel(), width.astype(np.uint64).ravel()

    def refresh(self, upto: int, told_now: np.ndarray, classes: np.ndarray) -> None:
        """Learn from contexts with what was right in them, and classes, of the latest steps; ``upto`` steps are done."""
        self.told += np.bincount(told_now.ravel(), minlength=self.told.size).reshape(self.told.shape)
        self.told >>= self.told.sum(axis=0) > _AGED
        self.told[_OTHER] |= 1
        self.weigh()
        now = np.bincount(classes.ravel(), minlength=self.used.size).reshape(self.used.shape)
        now[:, _NONE] = 0
        self.used += GAIN * now
        if upto % CLASS_REFRESH == 0:
            self.weigh_classes()


def _learned(held: np.ndarray, new: np.ndarray) -> np.ndarray:
    """What takes the place of ``held`` predictions; ``new`` predicts the id that came, with least confidence."""
    return np.where((held ^ new) < 4, np.minimum(held + 1, held | 3), new)


def _classed(counts: np.ndarray) -> np.ndarray:
    """Classes of ids by how often they are in their block: 1 to 4 by themselves, then two an octave."""
    if len(counts) and int(counts.max()) < len(_CLASS_OF):
        return _CLASS_OF.take(counts)
    octave = np.frexp(counts.astype(np.float64))[1] - 1
    return np.where(counts <= 4, counts - 1, np.minimum(2 * octave + (counts >> np.maximum(octave - 1, 0) & 1), _NONE - 1))


_CLASS_OF = np.zeros(0, np.uint8)
_CLASS_OF = _classed(np.arange(1 << 13)).clip(0).astype(np.uint8)


def _typical() -> np.ndarray:
    """About how often an id of each class is in its block."""
    classes = np.arange(CLASSES)
    return np.where(classes < 4, classes + 1, (1 << classes // 2) + (1 + 2 * (classes & 1) << classes // 2 >> 2))


def _alphabet(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids of a block by class, the size of each class, and the block in numbers of that list."""
    ids = np.sort(block)
    starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    ids, counts = ids[starts], np.diff(starts, append=len(ids))
    classes = _classed(counts).astype(np.uint8, copy=False)
    order = np.argsort(classes, kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    if ids[-1] < 1 << 18:
        place = np.empty(int(ids[-1]) + 1, np.int32)
        place[ids] = rank
        local = place[block]
    else:
        local = rank[np.searchsorted(ids, block)]
    return ids[order].astype(np.int64), np.bincount(classes, minlength=CLASSES), local


def _varints(values: np.ndarray) -> bytes:
    values = values.astype(np.uint64)
    sizes = 1 + sum((values >> np.uint64(7 * i) > 0).astype(np.int64) for i in range(1, 5))
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for i in range(5):
        has = sizes > i
        byte = ((values[has] >> np.uint64(7 * i)) & np.uint64(127)).astype(np.uint8)
        out[(ends - sizes)[has] + i] = byte | np.where(sizes[has] > i + 1, 128, 0).astype(np.uint8)
    return out.tobytes()


def _varint_lists(lists: list[np.ndarray]) -> list[bytes]:
    """The LEB128 bytes of each list of numbers."""
    values = np.concatenate(lists)
    sizes = 1 + sum((values >> 7 * i > 0).astype(np.int64) for i in range(1, 5))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    data = _varints(values)
    cuts = ends[np.cumsum([0, *map(len, lists)])].tolist()
    return [data[a:b] for a, b in zip(cuts, cuts[1:])]


def _from_varints(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    last = raw < 128
    owner = np.concatenate([[0], np.cumsum(last)[:-1]]) if len(raw) else np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], last[:-1]])) if len(raw) else np.zeros(0, np.int64)
    place = np.arange(len(raw)) - starts[owner] if len(raw) else owner
    out = np.zeros(len(starts), np.int64)
    np.add.at(out, owner, (raw & 127).astype(np.int64) << (7 * place))
    return out


def _context(held1: np.ndarray, held2: np.ndarray) -> np.ndarray:
    """Both confidences, and whether order 1 and order 2 say the same."""
    return ((held2 & 3) << 2 | (held1 & 3)) << 1 | ((held1 ^ held2) < 4)


def _hashed(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    return before * 40503 + last * 2531 & PAIR_SLOTS - 1


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Code blocks of ids (uint32, not empty)."""
    if not blocks:
        return []
    order = np.argsort([-len(b) for b in blocks], kind="stable")
    alphabets, sizes, local = zip(*(_alphabet(blocks[i]) for i in order))
    sizes = np.stack(sizes)
    n, lengths = len(local), np.array([len(x) for x in local])
    steps = int(lengths[0])
    by_block = np.zeros((n, steps + 2), np.int32)  # the last two places, then the block's ids, counted from 1
    for r, x in enumerate(local):
        by_block[r, 2 : len(x) + 2] = x + 1
    by_block[:, 2:][by_block[:, 2:] == 0] = 1
    ids = np.ascontiguousarray(by_block.T)
    del by_block
    model = _Model(sizes, sizes * _typical())
    class_of = np.concatenate([np.repeat(np.arange(CLASSES), s) for s in sizes])
    at_class_of = np.cumsum(sizes.sum(axis=1)) - sizes.sum(axis=1)
    low, width = np.zeros(n, np.uint64), np.full(n, _WIDEST)
    room = steps * 2 + 8
    words, filled = np.zeros(n * room, np.uint64), np.arange(n)  # the blocks' first words, their second words, ...
    active = np.searchsorted(-lengths, -np.arange(steps), "left").tolist()

    def move(low: np.ndarray, width: np.ndarray, k: int) -> None:
        r = np.flatnonzero(width < _NARROW)
        if len(r):
            at, l = filled[r], low[r]
            words[at] = l >> _24  # the bit above its 32 belongs to the word before
            filled[r] = at + n
            low[r] = (l & _REST) << _32
            width[r] <<= _32

    for start in range(0, steps, REFRESH):
        end, k = min(start + REFRESH, steps), active[start]
        before, last, now = (ids[start + d : end + d, :k].astype(np.int64) for d in range(3))
        at = np.concatenate([last + model.at_first[:k], _hashed(before, last) + model.at_second[:k]], axis=1)
        new = (now << 2 | 1).astype(model.held.dtype)
        new = np.concatenate([new, new], axis=1)
        held = np.empty(at.shape, new.dtype)
        for t in range(end - start):
            held[t] = model.held.take(at[t])
            model.held[at[t]] = _learned(held[t], new[t])
        hit1, hit2 = np.split((held ^ new) < 4, 2, axis=1)
        held1, held2 = np.split(held, 2, axis=1)
        contexts = _context(held1, held2) + model.at_context[:k]
        kinds = np.where(hit2, _HIT2, np.where(hit1, _HIT1, _OTHER))
        end2, end1 = model.end2[contexts], model.end1[contexts]
        at_kind = np.where(hit2, np.uint64(0), np.where(hit1, end2, end1))
        of_kind = np.where(hit2, end2, np.where(hit1, end1, np.uint64(1 << SLOT_BITS))) - at_kind
        classes = np.where(kinds == _OTHER, class_of[now - 1 + at_class_of[:k]], _NONE) + model.at_class[:k]
        at_class, of_class, of_size = model.class_low[classes], model.class_width[classes], model.size_of[classes]
        at_size = np.where(kinds == _OTHER, now - 1 - model.first_of[classes], 0).astype(np.uint64)
        for t in range(end - start):
            k = active[start + t]
            l, w = low[:k], width[:k]
            unit = w >> _SLOT
            l += unit * at_kind[t, :k]
            unit = unit * of_kind[t, :k] >> _CLASS
            l += unit * at_class[t, :k]
            np.multiply(unit, of_class[t, :k], out=w)
            move(l, w, k)
            w //= of_size[t, :k]
            l += w * at_size[t, :k]
            move(l, w, k)
        model.refresh(end, contexts + kinds * model.told.shape[1], classes)
    words[filled], words[filled + n] = low >> _24, (low & _REST) << _8
    filled = filled // n + 2
    words = words[: int(filled.max()) * n]
    while True:
        r = np.flatnonzero(words >> _32)
        if not len(r):
            break
        words[r] &= np.uint64((1 << 32) - 1)
        words[r - n] += np.uint64(1)
    words = np.ascontiguousarray(words.astype("<u4").reshape(-1, n).T)
    used = [s[: int(np.flatnonzero(s)[-1]) + 1] for s in sizes]
    letters = _varint_lists([np.concatenate([[len(s)], s, _steps(a, s)]) for a, s in zip(alphabets, used)])
    out: list[bytes] = [b""] * n
    for r, i in enumerate(order.tolist()):
        code = words[r, : filled[r]].tobytes()
        crc = zlib.crc32(blocks[i].astype("<u4").tobytes())
        out[i] = struct.pack(_HEAD, len(blocks[i]), len(alphabets[r]), len(letters[r]), len(code) // 4, crc) + letters[r] + code
    return out


def _steps(alphabet: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Differences of the ids of each class, from 0."""
    steps = np.diff(alphabet, prepend=0)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    steps[starts] = alphabet[starts]
    return steps


def _from_steps(steps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    sums = np.cumsum(steps)
    starts = np.cumsum(sizes) - sizes
    return sums - np.repeat(np.concatenate([[0], sums])[starts], sizes)


def decode_blocks(coded: list[bytes]) -> list[np.ndarray]:
    """The ids of coded blocks; raises ValueError where a checksum does not hold."""
    if not coded:
        return []
    heads = [struct.unpack_from(_HEAD, c) for c in coded]
    order = np.argsort([-h[0] for h in heads], kind="stable")
    lengths = np.array([heads[i][0] for i in order])
    n, steps, start = len(order), int(lengths[0]), struct.calcsize(_HEAD)
    alphabets, sizes = [], np.zeros((n, CLASSES), np.int64)
    width_of = max(heads[i][3] for i in order) + 2
    raw = np.zeros((n, width_of), np.uint32)
    for r, i in enumerate(order):
        _, size, letters, n_words, _ = heads[i]
        numbers = _from_varints(coded[i][start : start + letters])
        classes = int(numbers[0])
        if len(numbers) != 1 + classes + size or classes >= CLASSES or int(numbers[1 : 1 + classes].sum()) != size:
            raise ValueError("the alphabet of a block does not hold")
        sizes[r, :classes] = numbers[1 : 1 + classes]
        alphabets.append(_from_steps(numbers[1 + classes :], numbers[1 : 1 + classes]))
        raw[r, :n_words] = np.frombuffer(coded[i], "<u4", n_words, start + letters)
    model = _Model(sizes, sizes * _typical())
    code = (raw[:, 0].astype(np.uint64) << _24) | (raw[:, 1] >> np.uint32(8))
    words = (raw[:, 1:-1] << np.uint32(24) | raw[:, 2:] >> np.uint32(8)).T.ravel()  # the code after its first 56 bits, in words
    place, beyond = np.arange(n), len(words) - 1
    del raw
    width = np.full(n, _WIDEST)
    ids = np.zeros((steps, n), np.int32)
    active = np.searchsorted(-lengths, -np.arange(steps), "left").tolist()
    last, before = np.zeros(n, np.int64), np.zeros(n, np.int64)  # ids count from 1 here: a block's start is the same in any company
    told_now, classes = (np.tile(at, (REFRESH, 1)) for at in (model.at_context, model.at_class))  # ended blocks count for themselves
    right = np.zeros((2, REFRESH, n), np.int8)
    top, whole = np.uint64((1 << CLASS_BITS) - 1), np.uint64(1 << SLOT_BITS)
    one, nothing = np.uint64(1), np.uint64(0)
    least = model.held.dtype.type(1)
    keep = ~model.held.dtype.type(3)

    def move(k: int) -> None:
        r = np.flatnonzero(width[:k] < _NARROW)
        if len(r):
            at = place[r]
            code[r] = code[r] << _32 | words[np.minimum(at, beyond)]
            place[r] = at + n
            width[r] <<= _32

    for t, k in enumerate(active):
        row = t % REFRESH
        at = np.concatenate([last[:k] + model.at_first[:k], _hashed(before[:k], last[:k]) + model.at_second[:k]])
        held = model.held.take(at)
        held1, held2 = held[:k], held[k:]
        context = _context(held1, held2) + model.at_context[:k]
        end2, end1 = model.end2.take(context), model.end1.take(context)
        now, w = code[:k], width[:k]
        unit = w >> _SLOT
        up2, up1 = unit * end2, unit * end1
        is2, is1 = now < up2, now < up1
        now -= np.where(is2, nothing, np.where(is1, up2, up1))
        span = np.where(is2, end2, np.where(is1, end1 - end2, whole - end1))
        unit = unit * span >> _CLASS
        slot = np.minimum(now // unit, top).view(np.int64)
        klass = np.where(is1, _NONE, model.class_at.take(slot + model.at_slot[:k])) + model.at_class[:k]
        now -= unit * model.class_low.take(klass)
        np.multiply(unit, model.class_width.take(klass), out=w)
        move(k)
        size = model.size_of.take(klass)
        w //= size
        inside = np.minimum(now // w, size - one)
        now -= inside * w
        move(k)
        new = np.where(is1, np.where(is2, held2, held1) & keep | least, ((model.first_of.take(klass) + inside.view(np.int64)) * 4 + 5).astype(held.dtype))
        ids[t, :k] = found = new >> 2
        model.held[at] = _learned(held, np.concatenate([new, new]))
        before[:k] = last[:k]
        last[:k] = found
        told_now[row, :k], classes[row, :k] = context, klass
        right[0, row, :k], right[1, row, :k] = is2, is1
        if row == REFRESH - 1:
            model.refresh(t + 1, told_now + (_OTHER - right[0] - right[1]) * np.int64(model.told.shape[1]), classes)
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * n
    by_block = np.ascontiguousarray(ids.T)
    for r, i in enumerate(order.tolist()):
        found = alphabets[r].astype(np.uint32)[by_block[r, : heads[i][0]] - 1]
        if zlib.crc32(found.astype("<u4").tobytes()) != heads[i][4]:
            raise ValueError("checksum of a block does not hold")
        out[i] = found
    return out


def pack(streams: list[np.ndarray]) -> list[bytes]:
    """The payload of each stream of ids; all their blocks are coded together."""
    cut = [np.split(s, range(BLOCK_IDS, len(s), BLOCK_IDS)) if len(s) else [] for s in streams]
    coded = iter(encode_blocks(list(chain.from_iterable(cut))))
    out = []
    for blocks in cut:
        mine = [next(coded) for _ in blocks]
        out.append(struct.pack(f"<{len(mine) + 1}I", len(mine), *map(len, mine)) + b"".join(mine))
    return out


def unpack(payloads: list[bytes]) -> list[np.ndarray]:
    """The streams of ids of payloads."""
    cut = []
    for p in payloads:
        (n,) = struct.unpack_from("<I", p)
        sizes = struct.unpack_from(f"<{n}I", p, 4)
        ends = np.cumsum([4 + 4 * n, *sizes])
        cut.append([p[a:b] for a, b in zip(ends, ends[1:])])
    ids = iter(decode_blocks(list(chain.from_iterable(cut))))
    return [np.concatenate([next(ids) for _ in blocks]) if blocks else np.zeros(0, np.uint32) for blocks in cut]


class _Memory:
    """The ids of strings, one after another in one array."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.starts, self.sizes, self.flat, self.filled = np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int64), np.zeros(1 << 12, np.uint32), 0

    def add(self, strings: list[str], sizes: np.ndarray, flat: np.ndarray) -> None:
        n = len(self.place)
        while n + len(strings) > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros(len(x), x.dtype)]) for x in (self.starts, self.sizes))
        while self.filled + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        self.place.update(zip(strings, range(n, n + len(strings))))
        self.sizes[n : n + len(strings)] = sizes
        self.starts[n : n + len(strings)] = self.filled + np.cumsum(sizes) - sizes
        self.flat[self.filled : self.filled + len(flat)] = flat
        self.filled += len(flat)

    def find(self, strings: list[str]) -> np.ndarray:
        """Where the strings are; -1 for those that are not there."""
        return np.fromiter(map(self.place.get, strings, repeat(-1)), np.int64, len(strings))

    def ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the strings at these places, and how many each has."""
        return _stretches(self.flat, self.starts, self.sizes, places)


def _stretches(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of ``flat`` one after another, and their sizes."""
    sizes = sizes.take(which)
    ends = np.cumsum(sizes)
    at = np.repeat(starts.take(which) - (ends - sizes), sizes)
    at += np.arange(len(at))
    return flat.take(at), sizes


class _Encoder:
    """The tokenizers library, asked once for each token between white space: none of its steps reaches over it.

    Where the library's split sets letters apart and its merges mark the ends of words, plain
    words are given to its merges lower-cased, many in a call, and signs after them by themselves.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.pieces = _Memory()
        steps = json.loads(spec)
        normal = [n["type"] for n in (steps["normalizer"] or {}).get("normalizers", [])]
        split = [p.get("pattern", {}).get("Regex") for p in (steps["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.suffix, self.words = steps["model"].get("end_of_word_suffix"), None
        if self.suffix and normal == ["NFC", "Replace", "Lowercase"] and split == [_LETTERS_APART, None]:
            self.words, self.ascii_words = Tokenizer(Tokenizer.from_str(spec).model), Tokenizer(Tokenizer.from_str(spec).model)
            self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            self.ascii_words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()  # ASCII letters are their own byte letters
            self.ends_word = np.zeros(max(steps["model"]["vocab"].values()) + 1, bool)
            self.ends_word[[i for t, i in steps["model"]["vocab"].items() if t.endswith(self.suffix)]] = True

    def _ask(self, strings: list[str]) -> None:
        found = [np.array(f.ids, np.uint32) for f in self.library.encode_batch_fast(strings, add_special_tokens=False)]
        if found:
            self.pieces.add(strings, np.array([len(f) for f in found]), np.concatenate(found))

    def _ask_words(self, words: list[str], by) -> None:
        for i in range(0, len(words), 256):
            some = words[i : i + 256]
            (found,) = by.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(found.ids, np.uint32)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                self.pieces.add(some, np.diff(ends, prepend=0), ids)
            else:
                self._ask(some)

    def _places(self, strings: pa.Array, words: bool = False) -> np.ndarray:
        """Where distinct strings are remembered, after the library was asked for new ones."""
        names = strings.to_numpy(zero_copy_only=False).tolist()
        places = self.pieces.find(names)
        new = np.flatnonzero(places < 0)
        if len(new):
            first, asked = len(self.pieces.place), [names[i] for i in new.tolist()]
            if words:
                self._ask_words([p for p in asked if p.isascii()], self.ascii_words)
                self._ask_words([p for p in asked if not p.isascii()], self.words)
                places[new] = self.pieces.find(asked)
            else:
                self._ask(asked)
                places[new] = np.arange(first, first + len(asked))
        return places

    def _pieces(self, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct tokens, and how many each has."""
        if self.words is None:
            return self.pieces.ids(self._places(tokens))
        parts = pc.extract_regex(tokens, _WORD)
        plain = parts.is_valid().to_numpy(zero_copy_only=False)
        places = np.zeros((len(tokens), 2), np.int64)
        places[~plain, 0], places[:, 1] = self._places(tokens.filter(~plain)), self._places(pa.array([""]))
        if plain.any():
            word, signs = parts.filter(plain).flatten()
            word, signs = pc.utf8_lower(word).dictionary_encode(), signs.dictionary_encode()
            places[plain, 0] = self._places(word.dictionary, words=True).take(word.indices.to_numpy())
            places[plain, 1] = self._places(signs.dictionary).take(signs.indices.to_numpy())
        flat, sizes = self.pieces.ids(places.ravel())
        return flat, sizes.reshape(-1, 2).sum(axis=1)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each text has."""
        if pc.any(pc.match_substring_regex(texts, _ODD_SPACE.pattern)).as_py():
            split = pa.array([regex.split(r"\s+", t) if _ODD_SPACE.search(t) else t.split() for t in texts.to_pylist()], pa.list_(pa.string()))
        else:
            split = pc.utf8_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        if len(self.pieces.place) > REMEMBERED:
            self.pieces.clear()
        own, sizes = self._pieces(coded.dictionary)
        flat, sizes = _stretches(own, np.cumsum(sizes) - sizes, sizes, coded.indices.to_numpy())
        ends = np.concatenate([[0], np.cumsum(sizes)])[split.offsets.to_numpy()]
        return flat, np.diff(ends)


def _encoder(spec: str) -> _Encoder:
    return worker_keeps("ids", spec, lambda: _Encoder(spec))


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every row's whole text, each with ``end_id`` after it, in ascending id order."""
    shared = docs.sparkSession.sparkContext.broadcast(read_spec(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq = _encoder(shared.value), TaskContext.get().partitionId(), 0
        open_ids: list[int | None] = []
        open_lengths: list[int] = []
        streams: list[np.ndarray] = []
        ready: list[tuple[list, list, np.ndarray]] = []
        size = 0

        def rows() -> pa.RecordBatch:
            nonlocal seq
            payloads = pack([r[2] for r in ready])
            columns = [
                pa.array([part] * len(ready), pa.int32()), pa.array(range(seq, seq + len(ready)), pa.int32()),
                pa.array([r[0] for r in ready], pa.list_(pa.int64())), pa.array([r[1] for r in ready], pa.list_(pa.int64())),
                pa.array(payloads, pa.binary()),
            ]
            seq += len(ready)
            ready.clear()
            return pa.RecordBatch.from_arrays(columns, names=["part", "seq", "doc_ids", "lengths", "payload"])

        def close() -> None:
            nonlocal size
            if open_ids:
                ready.append((list(open_ids), list(open_lengths), np.concatenate(streams)))
                open_ids.clear()
                open_lengths.clear()
                streams.clear()
                size = 0

        for whole in batches:
            for batch in slices(whole, pc.utf8_length(whole.column("text")).to_numpy(zero_copy_only=False), CHARS_AT_ONCE):
                flat, lengths = encoder.ids(batch.column("text"))
                ends = np.cumsum(lengths)
                flat, ends = np.insert(flat, ends, end_id), ends + np.arange(1, len(ends) + 1)
                for name, a, b in zip(batch.column("id").to_pylist(), chain([0], ends.tolist()), ends.tolist()):
                    open_ids.append(name)
                    open_lengths.append(b - a)
                    streams.append(flat[a:b])
                    size += b - a
                    if size >= SEGMENT_IDS:
                        close()
                        if len(ready) == SEGMENTS_AT_ONCE:
                            yield rows()
        close()
        if ready:
            yield rows()

    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = given.repartitionByRange(F.col("id"), tie).sortWithinPartitions(F.col("id"), tie)
    small_batches(ordered).mapInArrow(run, "part int, seq int, doc_ids array<long>, lengths array<long>, payload binary").write.parquet(path)


def _read(spark: SparkSession, path: str, with_ids: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SEGMENTS_AT_ONCE):
                batch = whole.slice(at, SEGMENTS_AT_ONCE)
                streams = unpack(batch.column("payload").to_pylist())
                for r, stream in enumerate(streams):
                    lengths = np.array(batch.column("lengths")[r].as_py(), np.int64)
                    ends = np.cumsum(lengths)
                    if int(ends[-1]) != len(stream):
                        raise ValueError("the lengths of a segment do not match its ids")
                    starts = ends - lengths
                    raw = stream.astype("<u4")
                    crcs = [zlib.crc32(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                    n = len(lengths)
                    columns = [
                        pa.array([batch.column("part")[r].as_py()] * n, pa.int32()), pa.array([batch.column("seq")[r].as_py()] * n, pa.int32()),
                        batch.column("doc_ids")[r].values, pa.array(starts), pa.array(lengths), pa.array(crcs, pa.int64()),
                    ]
                    names = ["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), stream.astype(np.int32)))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    files = spark.read.parquet(path)
    totals = files.select("part", "seq", F.aggregate("lengths", F.lit(0).cast("long"), lambda s, n: s + n).alias("n"))
    parts = totals.groupBy("part").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))  # one row per written partition
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).join(parts, "part")
    bases = store(bases.select("part", "seq", (F.col("base") + F.col("part_start")).alias("base")), "bases")
    schema = "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    found = files.mapInArrow(run, schema).join(bases, ["part", "seq"])
    return found.withColumn("start", F.col("base") + F.col("inside")).drop("part", "seq", "base", "inside")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids of every document in a folder made by :func:`write_ids`."""
    return _read(spark, path, with_ids=True)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The same without the ids; blocks are decoded and their checksums verified all the same."""
    return _read(spark, path, with_ids=False)
