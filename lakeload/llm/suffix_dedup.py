"""Removal of long byte strings that an earlier document already holds.

A byte goes if a ``length``-byte string over it also starts in a document with
a smaller id. Repeats are found on merged Burrows-Wheeler transforms:

1. Every ``length``-byte window belongs to the class of its *anchor*, the least
   hash of the 16-byte strings in it, so equal windows share a class wherever
   they stand. Runs of windows of one class form one string.
2. Classes that occur in one document only are left out; their windows cannot
   repeat. The rest is dealt to buckets by class. Strings of classes that are
   very frequent are dealt window by window, by the window's own hash.
3. In a bucket, equal strings collapse into one. Windows whose hash no string
   of another smallest document has are settled: whatever equals them has
   their document. What is left of the strings is split into shards, each shard
   gets the transform of its own suffixes, sorted as deep as ``length``, and the
   transforms are merged by refining their interleave: each round prepends
   symbols to all suffixes by one stable sort, until the order is right to
   ``length`` symbols. Boundaries that appear on the way are the common
   prefixes; what no boundary splits at the end is a repeated interval. Suffixes
   of different shards are never compared. Equal hashes alone decide nothing.
4. Every interval's smallest document id goes back to the documents.

Documents are dealt to chunks of bounded size by their hash, so all groups are
bounded: chunks by bytes, buckets by their number, which follows the bytes of
the corpus, and frequent classes by the split. Every chunk sends a row to every
bucket, so buckets grow with the corpus up to a bound before their number does;
large ones are worked off part by part.

Null texts are empty. Rows without an id neither remove nor lose anything.
Rows that repeat an id count as one document. Texts shorter than ``length``
are kept whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakeload.llm.common import give_back

_GRAM = 16
_BATCH = 1 << 16  # bytes looked at at once
_FREQUENT = 20_000  # strings of a class beyond which its windows are dealt singly
_COUNTED = 64  # occurrences in a chunk beyond which a class's distinct strings are counted
_BUCKETS = 1000  # buckets beyond which they grow before they become more
_PARTS = 16  # parts of the largest bucket
_PART_BYTES = 1 << 20  # bytes of the corpus for each part
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9)]


def _grams(text: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 16 bytes from each position on."""
    eight = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,)).copy()
    h = eight[:-8] * _M[0]
    h ^= (eight[8:] * _M[1]) >> np.uint64(17)
    h += eight[8:]
    h ^= h >> np.uint64(32)
    h *= _M[2]
    h ^= h >> np.uint64(29)
    return h


def _window_hashes(text: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the ``length`` bytes from each position on."""
    eight = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,)).copy()
    count = len(text) - length + 1
    h = np.zeros(count, np.uint64)
    for at in (*range(0, length - 7, 8), length - 8):
        h ^= eight[at : at + count]
        h *= _M[2]
        h ^= h >> np.uint64(29)
    return h


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    rest = width - size
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


class _Run:
    """Runs of windows of one class in a batch of texts."""

    def __init__(self, data: bytes, rows: np.ndarray, offsets: np.ndarray, sizes: np.ndarray, length: int) -> None:
        self.data = data
        text = np.frombuffer(data, np.uint8)
        begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        grams = _grams(text)
        anchors = _least(grams, length - _GRAM + 1)
        breaks = np.empty(len(anchors), bool)
        breaks[0] = True
        np.not_equal(anchors[1:], anchors[:-1], out=breaks[1:])
        breaks[begin] = True
        ends = begin + sizes - length + 1  # behind the last window of each piece
        breaks[ends[:-1]] = True
        at = np.flatnonzero(breaks)
        piece = np.searchsorted(begin, at, "right") - 1
        inside = at < ends[piece]
        stop = np.append(at[1:], len(anchors))
        self.first, self.stop, piece = at[inside], stop[inside], piece[inside]
        self.row = rows[piece]
        self.offset = offsets[piece] + self.first - begin[piece]
        self.anchor = anchors[self.first]
        self.sign = grams[self.first] * _M[0] + grams[self.stop + length - 1 - _GRAM] + (self.stop - self.first).astype(np.uint64)


def _runs(texts: list[bytes], length: int) -> Iterator[_Run]:
    """Runs of all texts; a long text is cut into overlapping pieces."""
    data: list[bytes] = []
    where: list[tuple[int, int, int]] = []
    held = 0
    for row, text in enumerate(texts):
        for start in range(0, len(text) - length + 1, _BATCH):
            piece = text[start : start + _BATCH + length - 1]
            data.append(piece)
            where.append((row, start, len(piece)))
            held += len(piece)
            if held >= _BATCH:
                yield _Run(b"".join(data), *np.array(where).T, length)
                data, where, held = [], [], 0
    if data:
        yield _Run(b"".join(data), *np.array(where).T, length)


def _documents(table: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts and ids of a chunk in an order that does not depend on the shuffle, and the rows they come from."""
    give_back()  # what the chunk before took
    ids, texts = table["_id"].to_pylist(), table["_text"].to_pylist()
    order = sorted((i for i in range(len(ids)) if ids[i] is not None and texts[i]), key=lambda i: (ids[i], texts[i]))
    return [texts[i] for i in order], np.array([ids[i] for i in order], np.int64), np.array(order, np.int64)


def _blob(values: np.ndarray) -> bytes:
    return values.tobytes()


def _class_rows(length: int, groups: int):
    def rows(table: pa.Table) -> pa.Table:
        chunk = table["_chunk"][0].as_py()
        texts, ids, _ = _documents(table)
        found = [(r.anchor, r.sign, ids[r.row]) for r in _runs(texts, length)]
        if not found:
            return pa.Table.from_pylist([], _CLASS)
        anchor, sign, doc = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(anchor)
        anchor, doc = anchor[order], doc[order]
        at = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        count = np.diff(np.append(at, len(anchor)))
        several = (np.minimum.reduceat(doc, at) < np.maximum.reduceat(doc, at)).astype(np.uint8)
        # a class's number of distinct strings matters only where it may be large
        strings = np.minimum(count, 65535).astype(np.uint16)
        for i in np.flatnonzero(count > _COUNTED):
            strings[i] = min(len(np.unique(sign[order[at[i] : at[i] + count[i]]])), 65535)
        anchor = anchor[at]
        bucket = ((anchor >> np.uint64(20)) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.flatnonzero(np.diff(bucket[order])) + 1
        return pa.Table.from_pylist(
            [
                {"_bucket": int(bucket[i[0]]), "_chunk": chunk, "_classes": _blob(anchor[i]), "_strings": _blob(strings[i]), "_several": _blob(several[i])}
                for i in np.split(order, cut)
            ],
            _CLASS,
        )

    return rows


_CLASS = pa.schema([("_bucket", pa.int32()), ("_chunk", pa.int32()), ("_classes", pa.binary()), ("_strings", pa.binary()), ("_several", pa.binary())])


def _repeated_classes(table: pa.Table) -> pa.Table:
    """For each chunk, those of its classes that occur in several documents, and which are frequent."""
    chunks = table["_chunk"].to_pylist()
    anchors = [np.frombuffer(x, np.uint64) for x in table["_classes"].to_pylist()]
    anchor = np.concatenate(anchors)
    strings = np.concatenate([np.frombuffer(x, np.uint16) for x in table["_strings"].to_pylist()])
    several = np.concatenate([np.frombuffer(x, np.uint8) for x in table["_several"].to_pylist()])
    source = np.repeat(np.arange(len(chunks)), [len(a) for a in anchors])
    order = np.argsort(anchor)
    ranked = anchor[order]
    at = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    count = np.diff(np.append(at, len(ranked)))
    repeated = (count > 1) | (np.maximum.reduceat(several[order], at) > 0)
    frequent = np.add.reduceat(strings[order].astype(np.int64), at) > _FREQUENT
    keep, often = np.repeat(repeated, count), np.repeat(frequent, count)
    picked, hot = order[keep], often[keep].astype(np.uint8)
    by_source = np.argsort(source[picked], kind="stable")
    picked, hot = picked[by_source], hot[by_source]
    cut = np.flatnonzero(np.diff(source[picked])) + 1
    parts = zip(np.split(picked, cut), np.split(hot, cut)) if len(picked) else ()
    return pa.Table.from_pylist(
        [{"_chunk": chunks[source[i[0]]], "_classes": _blob(anchor[i]), "_frequent": _blob(h)} for i, h in parts], _REPEATED
    )


_REPEATED = pa.schema([("_chunk", pa.int32()), ("_classes", pa.binary()), ("_frequent", pa.binary())])


class _Strings:
    """The distinct strings of a chunk that may repeat, numbered alike whenever the chunk is read."""

    def __init__(self, texts: list[bytes], ids: np.ndarray, classes: pa.Table, length: int) -> None:
        anchors = np.concatenate([np.frombuffer(x, np.uint64) for x in classes["_classes"].to_pylist()] or [np.zeros(0, np.uint64)])
        hot = np.concatenate([np.frombuffer(x, np.uint8) for x in classes["_frequent"].to_pylist()] or [np.zeros(0, np.uint8)])
        order = np.argsort(anchors)
        anchors, hot = anchors[order], hot[order]
        numbers: dict[bytes, int] = {}
        number, row, place, key = [], [], [], []
        for run in _runs(texts, length) if len(anchors) else ():
            at = np.minimum(np.searchsorted(anchors, run.anchor), len(anchors) - 1)
            i = np.flatnonzero(anchors[at] == run.anchor)
            often = hot[at[i]] > 0
            for single in (False, True):
                j = i[often == single]
                if not len(j):
                    continue
                first, stop, rows, offset = run.first[j], run.stop[j], run.row[j], run.offset[j]
                if single:
                    n = stop - first
                    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    first, rows, offset = np.repeat(first, n) + within, np.repeat(rows, n), np.repeat(offset, n) + within
                    stop = first + 1
                data = run.data
                strings = [data[a:b] for a, b in zip(first.tolist(), (stop + length - 1).tolist())]
                number.append(np.array([numbers.setdefault(x, len(numbers)) for x in strings], np.int64))
                row.append(rows)
                place.append(offset)
                key.append(np.array([xxhash.xxh64_intdigest(x) for x in strings], np.uint64) if single else run.anchor[j])
        none = [np.zeros(0, np.int64)]
        self.strings = list(numbers)
        self.number, self.row, self.at = (np.concatenate(x or none) for x in (number, row, place))
        self.key = np.empty(len(numbers), np.uint64)
        self.key[self.number] = np.concatenate(key or [np.zeros(0, np.uint64)])
        docs = ids[self.row] if len(self.row) else none[0]
        self.least = np.full(len(numbers), np.iinfo(np.int64).max)
        self.most = np.full(len(numbers), np.iinfo(np.int64).min)
        np.minimum.at(self.least, self.number, docs)
        np.maximum.at(self.most, self.number, docs)


_STRINGS = pa.schema([("_bucket", pa.int32()), ("_chunk", pa.int32()), ("_count", pa.int32()), ("_packed", pa.binary())])


def _pack(numbers: np.ndarray, sizes: np.ndarray, least: np.ndarray, several: np.ndarray, part: np.ndarray, strings: list[bytes]) -> bytes:
    """A chunk's strings for one bucket with their facts, compressed: they are what is shuffled most."""
    facts = [numbers.astype(np.int32), sizes.astype(np.int32), least.astype(np.int64), several.astype(np.uint8), part.astype(np.uint8)]
    # bytes of equal weight side by side compress better
    sides = [np.ascontiguousarray(f.view(np.uint8).reshape(len(f), -1).T).tobytes() for f in facts]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(sides + strings))


def _unpack(packed: bytes, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    data, at, facts = zstandard.ZstdDecompressor().decompress(packed), 0, []
    for kind, width in ((np.int32, 4), (np.int32, 4), (np.int64, 8), (np.uint8, 1), (np.uint8, 1)):
        sides = np.frombuffer(data, np.uint8, width * count, at).reshape(width, count)
        facts.append(np.ascontiguousarray(sides.T).view(kind).reshape(count))
        at += width * count
    return *facts, data[at:]


def _string_rows(length: int, buckets: int, parts: int):
    def rows(key, table: pa.Table, classes: pa.Table) -> pa.Table:
        texts, ids, _ = _documents(table) if table.num_rows else ([], np.zeros(0, np.int64), None)
        found = _Strings(texts, ids, classes, length)
        if not found.strings:
            return pa.Table.from_pylist([], _STRINGS)
        bucket = ((found.key >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.array([len(s) for s in found.strings], np.int32)
        part = (found.key >> np.uint64(56)) % np.uint64(parts)
        several, out = found.least < found.most, []
        for i in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            packed = _pack(i, sizes[i], found.least[i], several[i], part[i], [found.strings[j] for j in i.tolist()])
            out.append({"_bucket": int(bucket[i[0]]), "_chunk": key[0].as_py(), "_count": len(i), "_packed": packed})
        return pa.Table.from_pylist(out, _STRINGS)

    return rows


def _sorted_with_places(keys: np.ndarray, place_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys that leave ``place_bits`` free at the top, and which sorted ones differ from the one before."""
    keys = keys << np.uint64(place_bits) | np.arange(len(keys), dtype=np.uint64)
    keys.sort()
    order = (keys & np.uint64((1 << place_bits) - 1)).astype(np.int64)
    keys >>= np.uint64(place_bits)
    return order, keys[1:] != keys[:-1]


def _numbered(parted: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Numbers that rise by one at each bound."""
    out[0] = 0
    np.cumsum(parted.astype(out.dtype), out=out[1:])
    return out


def _packed(text: np.ndarray, width: int, bits: int) -> np.ndarray:
    """The ``width`` symbols from each position of a circular text, as numbers that sort like them."""
    packed, have = text.astype(np.uint64), 1
    out, done = np.zeros(len(text), np.uint64), 0
    while True:
        if width & have:
            out = out << np.uint64(bits * have) | np.roll(packed, -done)
            done += have
        if have * 2 > width:
            return out
        packed = packed << np.uint64(bits * have) | np.roll(packed, -have)
        have *= 2


def sorted_suffixes(text: np.ndarray, depth: int, bits: int = 8) -> np.ndarray:
    """Positions of a circular text of under 2 ** 21 symbols ordered by the ``depth`` symbols from each on."""
    size = len(text)
    place_bits = max(1, int(size - 1).bit_length())
    have = min((64 - place_bits) // bits, depth)
    order, parted = _sorted_with_places(_packed(text, have, bits), place_bits)
    rank = np.empty(size, np.uint64)
    while have < depth:
        rank[order] = _numbered(parted, np.empty(size, np.uint64))
        step = min(have, depth - have)
        order, parted = _sorted_with_places(rank << np.uint64(place_bits) | np.roll(rank, -step), place_bits)
        have += step
    return order


def merge_transforms(shards: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge the shards' transforms; return each position's interval and the bounds' common prefixes.

    Positions count through the shards one after another. Positions have the
    same interval number exactly if the ``depth`` symbols from them on, around
    the end of their shard, are equal. The second result holds for each bound
    between neighbouring suffixes in merged order a depth up to which they are
    known to agree, or ``depth`` where nothing parts them.
    """
    sizes = [len(s) for s in shards]
    base = np.cumsum([0, *sizes])
    total = int(base[-1])
    whole = np.concatenate(shards)
    alphabet = np.zeros(256, np.uint8)
    used = np.flatnonzero(np.bincount(whole, minlength=256))
    alphabet[used] = np.arange(len(used))
    bits = max(1, int(len(used) - 1).bit_length())
    shards = [alphabet[s] for s in shards]
    orders = [sorted_suffixes(s, depth, bits) for s in shards]
    place_bits = max(1, int(total - 1).bit_length())
    step = (64 - place_bits) // bits  # symbols that fit a sort key beside a place
    widths = [step] * (depth // step) + ([depth % step] if depth % step else [])
    transforms = {w: [_packed(s, w, bits)[o - w] for s, o in zip(shards, orders)] for w in set(widths)}
    interleave = np.repeat(np.arange(len(shards), dtype=np.uint16 if len(shards) < 65536 else np.uint32), sizes)
    interval = np.zeros(total, np.int32 if total < 2**31 else np.int64)
    agree = np.zeros(max(total - 1, 0), np.int32)
    symbols = np.empty(total, np.uint64)
    for width in widths:
        for shard, place in enumerate(_places(interleave, len(shards), base)):
            symbols[place] = transforms[width][shard]  # in the order of the interleave so far
        order, parted = _sorted_with_places(symbols, place_bits)
        interleave, interval = interleave[order], interval[order]
        parted |= interval[1:] != interval[:-1]
        agree += np.where(parted, np.int32(0), np.int32(width))
        _numbered(parted, interval)
    at = np.empty(total, interval.dtype)
    for shard, place in enumerate(_places(interleave, len(shards), base)):
        at[orders[shard] + base[shard]] = interval[place]
    return at, agree


def _places(interleave: np.ndarray, shards: int, base: np.ndarray) -> list[np.ndarray]:
    """For each shard, the places its suffixes take."""
    if shards <= 8:
        return [np.flatnonzero(interleave == shard) for shard in range(shards)]
    order = np.argsort(interleave, kind="stable")
    return [order[base[shard] : base[shard + 1]] for shard in range(shards)]


_VERDICT = pa.schema([("_chunk", pa.int32()), ("_numbers", pa.binary()), ("_from", pa.binary()), ("_to", pa.binary()), ("_first", pa.binary())])


def _contested(text: np.ndarray, places: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """Which windows share their hash with one of another smallest document."""
    hashes = _window_hashes(text, length)[places]
    order = np.argsort(hashes)
    ranked, docs = hashes[order], docs[order]
    at = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    differ = np.minimum.reduceat(docs, at) < np.maximum.reduceat(docs, at)
    out = np.empty(len(order), bool)
    out[order] = np.repeat(differ, np.diff(np.append(at, len(order))))
    return out


def _smallest_documents(strings: list[bytes], least: np.ndarray, length: int, shard_bytes: int) -> tuple[np.ndarray, ...]:
    """For distinct strings the stretches of their windows by the smallest document that has them: string, from, to and document."""
    sizes = np.array([len(s) for s in strings], np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes)))
    text = np.frombuffer(b"".join(strings), np.uint8)
    # windows are the positions with a whole string of the length before the end of theirs
    windows = sizes - length + 1
    opening = np.concatenate(([0], np.cumsum(windows)))
    owner = np.repeat(np.arange(len(strings)), windows)
    within = np.arange(opening[-1]) - opening[owner]
    place, first = begin[owner] + within, least[owner]
    open_windows = np.flatnonzero(_contested(text, place, first, length))
    if len(open_windows):
        # neighbouring windows of one string are one piece, and equal pieces are one
        leap = np.concatenate(([True], np.diff(place[open_windows]) > 1))
        starts = place[open_windows[leap]]
        count = np.diff(np.append(np.flatnonzero(leap), len(open_windows)))
        data, known = text.tobytes(), {}
        piece = np.array([known.setdefault(data[a:b], len(known)) for a, b in zip(starts.tolist(), (starts + count + length - 1).tolist())], np.int64)
        piece_begin = np.concatenate(([0], np.cumsum([len(p) for p in known])))
        pieces = np.frombuffer(b"".join(known), np.uint8)
        shard = piece_begin[:-1] // shard_bytes
        cuts = piece_begin[np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [len(known)]))]
        interval, _ = merge_transforms([pieces[a:b] for a, b in zip(cuts[:-1], cuts[1:])], length)
        number = np.cumsum(leap) - 1
        at = interval[piece_begin[piece[number]] + place[open_windows] - starts[number]]
        smallest = np.full(int(interval.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(smallest, at, first[open_windows])
        first[open_windows] = smallest[at]
    turn = np.flatnonzero(np.concatenate(([True], (first[1:] != first[:-1]) | (owner[1:] != owner[:-1]))))
    return owner[turn], within[turn], within[turn] + np.diff(np.append(turn, len(first))), first[turn]


def _verdicts(length: int, shard_bytes: int):
    def rows(table: pa.Table) -> pa.Table:
        give_back()
        known: dict[bytes, int] = {}
        least: list[int] = []
        part_of: list[int] = []
        uses = []
        for chunk, count, packed in zip(*(table[c].to_pylist() for c in ("_chunk", "_count", "_packed"))):
            numbers, sizes, firsts, several, part, data = _unpack(packed, count)
            at, mine = 0, []
            for size, first, p in zip(sizes.tolist(), firsts.tolist(), part.tolist()):
                string = data[at : at + size]
                at += size
                k = known.setdefault(string, len(known))
                if k == len(least):
                    least.append(first)
                    part_of.append(p)
                elif first < least[k]:
                    least[k] = first
                mine.append(k)
            uses.append((chunk, numbers, firsts, several, np.array(mine, np.int64)))
        strings, docs, part = list(known), np.array(least, np.int64), np.array(part_of, np.int64)
        del known
        found = []
        for p in np.unique(part):  # equal windows are of one part
            i = np.flatnonzero(part == p)
            owner, *stretches = _smallest_documents([strings[j] for j in i.tolist()], docs[i], length, shard_bytes)
            found.append((i[owner], *stretches))
        stretch_owner, stretch_from, stretch_to, stretch_first = (np.concatenate(x) for x in zip(*found))
        if len(found) > 1:
            order = np.argsort(stretch_owner, kind="stable")
            stretch_owner, stretch_from, stretch_to, stretch_first = (x[order] for x in (stretch_owner, stretch_from, stretch_to, stretch_first))
        opens = np.searchsorted(stretch_owner, np.arange(len(strings) + 1))
        out = []
        for chunk, numbers, firsts, several, mine in uses:
            count = opens[mine + 1] - opens[mine]
            use = np.repeat(np.arange(len(mine)), count)
            s = np.repeat(opens[mine], count) + np.arange(len(use)) - np.repeat(np.cumsum(count) - count, count)
            # nothing goes in a chunk whose only document with the string is the first
            needed = (stretch_first[s] < firsts[use]) | (several[use] > 0)
            use, s = use[needed], s[needed]
            if len(use):
                out.append(
                    {"_chunk": chunk, "_numbers": _blob(numbers[use]), "_from": _blob(stretch_from[s].astype(np.int32)), "_to": _blob(stretch_to[s].astype(np.int32)), "_first": _blob(stretch_first[s])}
                )
        return pa.Table.from_pylist(out, _VERDICT)

    return rows


def _covered(size: int, starts: np.ndarray, stops: np.ndarray, length: int) -> np.ndarray:
    """Bytes of a text under windows that start in the given stretches."""
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, stops + length - 1, -1)
    return np.cumsum(change[:-1]) > 0


def _kept_rows(length: int, schema: pa.Schema):
    def rows(_key, table: pa.Table, both: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.Table.from_pylist([], schema)
        texts, ids, source = _documents(table)
        sent = both["_kind"].to_pylist()
        classes = both.filter(pa.array([k == 0 for k in sent]))
        verdicts = both.filter(pa.array([k == 1 for k in sent]))
        spans: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        if verdicts.num_rows:
            found = _Strings(texts, ids, classes, length)
            number, start, stop, first = (
                np.concatenate([np.frombuffer(x, kind) for x in verdicts[c].to_pylist()])
                for c, kind in (("_numbers", np.int32), ("_from", np.int32), ("_to", np.int32), ("_first", np.int64))
            )
            order = np.argsort(number, kind="stable")
            number, start, stop, first = number[order], start[order], stop[order], first[order]
            lo, hi = np.searchsorted(number, found.number), np.searchsorted(number, found.number, "right")
            count = hi - lo
            use = np.repeat(np.arange(len(lo)), count)
            v = np.repeat(lo, count) + np.arange(len(use)) - np.repeat(np.cumsum(count) - count, count)
            gone = first[v] < ids[found.row[use]]
            use, v = use[gone], v[gone]
            row, begin, end = found.row[use], found.at[use] + start[v], found.at[use] + stop[v]
            order = np.argsort(row, kind="stable")
            for i in np.split(order, np.flatnonzero(np.diff(row[order])) + 1) if len(order) else ():
                spans[int(source[row[i[0]]])] = (begin[i], end[i])
        out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept_text": []}
        for i, text in enumerate(table["_text"].to_pylist()):
            text = text or b""
            kept, removed, runs = text, 0, 0
            if i in spans:
                mask = _covered(len(text), *spans[i], length)
                kept = np.frombuffer(text, np.uint8)[~mask].tobytes()
                removed, runs = int(mask.sum()), int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
            out["n_bytes"].append(len(text))
            out["n_removed"].append(removed)
            out["n_spans"].append(runs)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept_text"].append(kept.decode("utf-8", "ignore"))
        carried = {f.name: table[f.name] for f in schema if f.name not in out}
        return pa.table({f.name: carried.get(f.name, pa.array(out[f.name], f.type) if f.name in out else None) for f in schema}, schema)

    return rows


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 50,
    chunk_bytes: int = 4 << 20,
    bucket_bytes: int = 512 << 10,
    shard_bytes: int = 64 << 10,
    with_text: bool = True,
) -> DataFrame:
    """Rows of ``docs`` as ``_row`` (a struct of all their columns) with what is left of each text.

    Adds ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs),
    ``kept_sha256`` of the bytes left and, unless ``with_text`` is off,
    ``kept_text`` (a character that was cut in two is dropped from it).
    """
    if length < 24:
        raise ValueError("strings shorter than 24 bytes are not searched for")
    bytes_of = F.col(f"`{text_col}`").cast("binary")
    total = docs.agg(F.sum(F.octet_length(bytes_of))).first()[0] or 0
    chunks = total // chunk_bytes + 1
    # every chunk sends rows to every bucket and group: as many of those as give work to many cores, and more only where they would get too large
    most = max(bucket_bytes, _PART_BYTES)
    bucket = min(max(total // _BUCKETS, bucket_bytes), most * _PARTS)
    buckets, parts = total // bucket + 1, -(-bucket // most)
    groups = min(chunks, max(_BUCKETS, total // (8 * chunk_bytes)))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if with_text else F.struct(F.col(f"`{id_col}`"))
    keyed = docs.select(row.alias("_row"), F.col(f"`{id_col}`").cast("long").alias("_id"), bytes_of.alias("_text"))
    keyed = keyed.withColumn("_chunk", F.pmod(F.xxhash64("_id", "_text"), F.lit(chunks)).cast("int"))
    if with_text:  # the text travels once, in bytes
        keyed = keyed.withColumn("_row", F.col("_row").dropFields(text_col) if len(docs.columns) > 1 else F.struct(F.lit(1).alias("_")))
    by_chunk = keyed.groupBy("_chunk")
    classes = by_chunk.applyInArrow(_class_rows(length, groups), _ddl(_CLASS))
    repeated = classes.groupBy("_bucket").applyInArrow(_repeated_classes, _ddl(_REPEATED))
    strings = by_chunk.cogroup(repeated.groupBy("_chunk")).applyInArrow(_string_rows(length, buckets, parts), _ddl(_STRINGS))
    verdicts = strings.groupBy("_bucket").applyInArrow(_verdicts(length, shard_bytes), _ddl(_VERDICT))
    sent = repeated.withColumn("_kind", F.lit(0)).unionByName(verdicts.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    added = [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ] + ([T.StructField("kept_text", T.StringType())] if with_text else [])
    schema = T.StructType([f for f in keyed.schema if f.name == "_row"] + added)
    return by_chunk.cogroup(sent.groupBy("_chunk")).applyInArrow(_kept_rows(length, to_arrow_schema(schema)), schema)


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'binary'}" for f in schema)


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, **sizes: int) -> DataFrame:
    """``docs`` with the repeated strings taken out of their texts; all other columns stay."""
    kept = remove_repeats(docs, id_col, text_col, length, **sizes)
    inner = [f.name for f in kept.schema["_row"].dataType.fields]
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(F.col("kept_text").alias(c))
        elif c in inner:
            columns.append(F.col("_row").getField(c).alias(c))
    return kept.select(*columns)
