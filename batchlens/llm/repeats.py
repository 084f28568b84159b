"""Removal of long byte strings that an earlier document holds, by prefix-free parsing.

Every byte that lies in a `LENGTH`-byte string which also starts in a document with a smaller id is removed; all
strings are judged on the input texts.

*Parsing.* A rolling hash runs over the bytes. A place is a trigger if its `GRAM`-byte window has the least hash of
some run of windows as long as a `LENGTH`-byte string; so every such string has a trigger of its own, equal strings
have equal triggers, and triggers cut all texts into phrases at the same places wherever the bytes repeat.

1. *Units.* Tasks pack documents into compressed units, a table that all later steps read.
2. *Screen.* Trigger windows of `SCREEN_GRAM` bytes are counted over all units. A string can only repeat if its
   trigger window does, so only runs of such strings (regions) go on.
3. *Dictionary.* The phrase of a trigger is all bytes of the strings it can be the trigger of. For each different
   phrase the dictionary has the smallest id that holds it, and for each trigger window whether it stands in more
   than one phrase. Strings of a phrase that an earlier document holds are removed together. Where a window has one
   phrase only, the dictionary settles all its strings.
4. *Suffixes.* The first holder of a string is never in a phrase that step 3 removes, so for windows with several
   phrases the suffixes of the phrases that are left suffice. The least id of each `LENGTH`-byte prefix of a suffix
   is found the same way.
5. Spans of removed bytes go back to their units and are cut out.

The whole-corpus order of suffixes is not built: here only equality of `LENGTH`-byte prefixes counts, so equal
suffixes meet by a 128-bit fingerprint instead of by rank. Each unit sends a fingerprint once, with its least id, so
a passage that a third of all documents share costs an owner task one entry per unit.

Defined results: NULL and short texts keep all their bytes. NULL ids come after all others; rows with equal ids
remove nothing from each other. An empty table gives an empty result. Ids must be whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from batchlens.llm.common import hold_tables, stage_and_free as stage

LENGTH = 50
GRAM = 24
#: Trigger windows of the screen; nearly as long as a string, so that few of them repeat by chance.
SCREEN_GRAM = 40
#: Bytes of text in a unit, and bytes hashed at once.
UNIT_BYTES = 4 << 20
BUFFER_BYTES = 1 << 20
#: Bytes of text per part of the fingerprint exchanges.
PART_BYTES = 64 << 20
LAST_ID = np.iinfo(np.int64).max

#: Of the two halves of a fingerprint.
_BASES = (0xD6E8FEB86659FD93, 0xA3B195354A39B70D)
_BASE_INVERSES = tuple(pow(b, -1, 2**64) for b in _BASES)
_BYTE_VALUES = [np.random.default_rng(seed).integers(0, 2**64, 256, dtype=np.uint64) for seed in (2024, 2025)]
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, size: int) -> np.ndarray:
    """base**0 ... base**(size - 1), modulo 2**64; grown on demand and kept."""
    hold_tables("repeats", _powers.clear)
    known = _powers.get(base)
    if known is None or len(known) < size:
        known = np.full(max(size, 2 * BUFFER_BYTES), base, np.uint64)
        known[0] = 1
        np.cumprod(known, out=known)
        _powers[base] = known
    return known[:size]


class Fingerprints:
    """64-bit halves (0 or 1) of the fingerprints of any substring of a buffer, from running sums."""

    def __init__(self, buffer: np.ndarray, half: int = 0):
        n = len(buffer)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[half][buffer] * _power_table(_BASES[half], n), out=self._sums[1:])
        self._shift = _power_table(_BASE_INVERSES[half], n + 1)

    def windows(self, length: int) -> np.ndarray:
        """Of the substring of `length` bytes at each place."""
        n = len(self._sums) - length
        return self._mixed((self._sums[length:] - self._sums[:n]) * self._shift[:n])

    def at(self, starts: np.ndarray, lengths) -> np.ndarray:
        return self._mixed((self._sums[starts + lengths] - self._sums[starts]) * self._shift[starts])

    @staticmethod
    def _mixed(x: np.ndarray) -> np.ndarray:
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        return x


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each run of `width` values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


class Parsed:
    """Triggers of the `length`-byte strings that lie within one document of a buffer."""

    def __init__(self, buffer: np.ndarray, sizes: np.ndarray, length: int, gram: int):
        self.buffer = buffer
        self.prints = Fingerprints(buffer)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        n, self.width = len(buffer), length - gram + 1
        self.valid = np.zeros(max(n - length + 1, 0), bool)
        for a, b in zip(self.starts.tolist(), self.ends.tolist()):
            if b - a >= length:
                self.valid[a : b - length + 1] = True
        if not self.valid.any():
            self.tokens = np.zeros(0, np.uint64)
            self.least = self.triggers = np.zeros(0, np.int64)
            return
        # 0 is kept for "no string here".
        self.tokens = np.maximum(self.prints.windows(gram), np.uint64(1))
        self.least = _sliding(self.tokens, self.width, np.minimum)
        self.least[~self.valid] = 0
        pad = np.zeros(self.width - 1, np.uint64)
        most = _sliding(np.concatenate([pad, self.least, pad]), self.width, np.maximum)
        self.triggers = np.flatnonzero(most == self.tokens)

    def strings_of(self, chosen: np.ndarray) -> np.ndarray:
        """The strings (by start) that have one of the chosen triggers (a flag for each)."""
        if not chosen.any():
            return np.zeros(len(self.valid), bool)
        marked = np.full(len(self.tokens), np.iinfo(np.uint64).max, np.uint64)
        places = self.triggers[chosen]
        marked[places] = self.tokens[places]
        return (_sliding(marked, self.width, np.minimum) == self.least) & self.valid

    def repeated(self, windows: np.ndarray) -> np.ndarray:
        """The strings whose trigger window is among `windows` (sorted)."""
        own = self.tokens[self.triggers]
        if not len(own) or not len(windows):
            return np.zeros(len(self.valid), bool)
        return self.strings_of(np.take(windows, np.searchsorted(windows, own), mode="clip") == own)

    def phrases(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each trigger: its document, and both halves of the fingerprint of its phrase with the place of the
        trigger in it."""
        doc = np.searchsorted(self.ends, self.triggers, "right")
        first = np.maximum(self.triggers - self.width + 1, self.starts[doc])
        last = np.minimum(self.triggers + length, self.ends[doc])
        place = (self.triggers - first).astype(np.uint64) * np.uint64(2 * length) + (last - first).astype(np.uint64)
        halves = (self.prints, Fingerprints(self.buffer, 1))
        return doc, *(Fingerprints._mixed(x.at(first, last - first) ^ place) for x in halves)


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def _buffers(text: bytes, sizes: np.ndarray):
    """Splits a unit into buffers of whole documents: (number of the first document, bytes, sizes)."""
    first, begin, held = 0, 0, 0
    for i, size in enumerate(sizes.tolist()):
        held += size
        if held >= BUFFER_BYTES or i == len(sizes) - 1:
            yield first, np.frombuffer(text, np.uint8, held, begin), sizes[first : i + 1]
            first, begin, held = i + 1, begin + held, 0


def _opened(row: dict) -> tuple[bytes, np.ndarray]:
    return zstandard.decompress(row["text"]), np.frombuffer(row["sizes"], "<i8")


def _order_ids(row: dict) -> np.ndarray:
    return np.array([LAST_ID if x["id"] is None else x["id"] for x in row["ids"]], "<i8")


def _pack(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = TaskContext.get().partitionId() << 32
        ids: list = []
        texts: list[bytes] = []
        held = 0

        def flush():
            sizes = np.array([len(x) for x in texts], "<i8")
            row = {"unit": unit, "ids": ids, "sizes": sizes.tobytes(), "text": zstandard.compress(b"".join(texts), 3)}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            # A row is its id and the columns it carries along.
            for i, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
                ids.append(i)
                texts.append(text.encode())
                held += len(texts[-1])
                if held >= UNIT_BYTES:
                    yield flush()
                    unit, held = unit + 1, 0
                    ids.clear()
                    texts.clear()
        if ids:
            yield flush()

    return run


def _packed(values: np.ndarray) -> bytes:
    """Numbers in rising order, as compressed differences, byte plane by byte plane."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return zstandard.compress(steps.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def _unpacked(packed: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(dtype).ravel(), dtype=dtype)


def _part_order(deal_by: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of entries by part, and where each part begins in it."""
    part = (deal_by % deal_by.dtype.type(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _dealt(deal_by: np.ndarray, columns: dict, unit: int, parts: int, schema: pa.Schema, **whole):
    """Rows of one unit's entries by part: `columns` has arrays and how to write them, `whole` goes with every row."""
    order, edges = _part_order(deal_by, parts)
    full = np.flatnonzero(np.diff(edges))
    rows = {"part": full, "unit": [unit] * len(full)}
    for name, (array, write) in columns.items():
        array = array[order]
        rows[name] = [write(array[edges[p] : edges[p + 1]]) for p in full]
    rows |= {name: [value] * len(full) for name, value in whole.items()}
    return pa.RecordBatch.from_pydict(rows, schema=schema)


def _plain(array: np.ndarray) -> bytes:
    return array.tobytes()


def _flags(replies: pa.Table, deal_by: np.ndarray, parts: int) -> np.ndarray:
    """The answers to a unit's entries, which come by part, in the order of the entries."""
    order, _ = _part_order(deal_by, parts)
    by_part = sorted(zip(replies["part"].to_pylist(), replies["flags"].to_pylist()))
    out = np.empty(len(order), np.uint8)
    out[order] = np.frombuffer(b"".join(x for _, x in by_part), np.uint8)
    return out


def _trigger_windows(row: dict, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Different trigger windows of a unit, sorted, and whether two of its documents hold each."""
    text, sizes = _opened(row)
    found = []
    for _, buffer, inside in _buffers(text, sizes):
        parsed = Parsed(buffer, inside, length, gram)
        owner = np.searchsorted(parsed.ends, parsed.triggers, "right")
        # Each window once for a document; owners rise already.
        own = parsed.tokens[parsed.triggers]
        order = np.argsort(own, kind="stable")
        own, owner = own[order], owner[order]
        first = np.ones(len(own), bool)
        first[1:] = (own[1:] != own[:-1]) | (owner[1:] != owner[:-1])
        found.append(own[first])
    windows = np.concatenate([*found, np.zeros(0, np.uint64)])
    windows, counts = np.unique(windows, return_counts=True)
    return windows, counts > 1


def _deal_windows(schema: pa.Schema, parts: int, length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                windows, twice = _trigger_windows(row, length, gram)
                if len(windows):
                    columns = {"keys": (windows, _packed), "twice": (twice, _plain)}
                    yield _dealt(windows, columns, row["unit"], parts, schema)

    return run


def _shared_windows(schema: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        keys = [_unpacked(x, np.uint64) for x in table["keys"].to_pylist()]
        _, inverse, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        twice = np.frombuffer(b"".join(table["twice"].to_pylist()), bool)
        shared = np.split((counts[inverse] > 1) | twice, np.cumsum([len(x) for x in keys])[:-1])
        return pa.table({"unit": table["unit"], "keys": [_packed(k[s]) for k, s in zip(keys, shared)]}, schema=schema)

    return run


def _merged(replies: pa.Table, name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(replies[name].to_pylist()), dtype)


def _region_columns(docs: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> dict:
    """Document in the unit, first byte in the document and size of each region."""
    return {
        "docs": zstandard.compress(docs.astype("<u4").tobytes(), 1),
        "places": zstandard.compress(places.astype("<u4").tobytes(), 1),
        "sizes": sizes.astype("<i8").tobytes(),
    }


def _region_numbers(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(zstandard.decompress(row[c]), "<u4").astype(np.int64) for c in ("docs", "places"))


def _region_ids(row: dict) -> np.ndarray:
    return np.frombuffer(row["ids"], "<i8")[_region_numbers(row)[0]]


def _regions(schema: pa.Schema, length: int, gram: int):
    """Runs of strings whose trigger window repeats: their document, place and bytes."""

    def run(units: pa.Table, replies: pa.Table) -> pa.Table:
        rows = []
        for row in units.to_pylist():
            answers = [_unpacked(x, np.uint64) for x in replies["keys"].to_pylist()]
            shared = np.sort(np.concatenate([*answers, np.zeros(0, np.uint64)]))
            text, sizes = _opened(row)
            docs, places, lengths, pieces = [], [], [], []
            for first, buffer, own in _buffers(text, sizes):
                parsed = Parsed(buffer, own, length, gram)
                starts, ends = _runs(parsed.repeated(shared))
                ends = ends + length - 1
                doc = np.searchsorted(parsed.ends, starts, "right")
                # Runs whose bytes meet are one region.
                apart = np.ones(len(starts), bool)
                apart[1:] = (starts[1:] > ends[:-1]) | (doc[1:] != doc[:-1])
                starts, doc, ends = starts[apart], doc[apart], ends[np.append(apart[1:], True)[: len(apart)]]
                docs.append(doc + first)
                places.append(starts - parsed.starts[doc])
                lengths.append(ends - starts)
                pieces += [buffer[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
            if pieces:
                flat = [np.concatenate(x) for x in (docs, places, lengths)]
                rows.append(
                    {
                        "unit": row["unit"],
                        "ids": _order_ids(row).tobytes(),
                        **_region_columns(*flat),
                        "text": zstandard.compress(b"".join(pieces), 3),
                    }
                )
        return pa.Table.from_pylist(rows, schema=schema)

    return run


def _parsed_regions(row: dict, length: int, gram: int):
    """The regions of a unit, parsed buffer by buffer: (first region, bytes before the buffer, parsed)."""
    text, sizes = _opened(row)
    begin = 0
    for first, buffer, own in _buffers(text, sizes):
        yield first, begin, Parsed(buffer, own, length, gram)
        begin += len(buffer)


def _phrase_entries(row: dict, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Trigger window, both halves of the phrase and document id of each trigger of a unit's regions."""
    ids = _region_ids(row)
    found = []
    for first, _, parsed in _parsed_regions(row, length, gram):
        doc, prints, more = parsed.phrases(length)
        found.append((parsed.tokens[parsed.triggers], prints, more, ids[doc + first]))
    return tuple(map(np.concatenate, zip(*found)))


class Groups:
    """Entries of equal fingerprints: one of each (`at`), its least id, and the number of each entry's group."""

    def __init__(self, keys: np.ndarray, more: np.ndarray, ids: np.ndarray):
        order = np.argsort(keys)
        same, other = self._neighbours(keys, more, order)
        if (same & other).any():  # equal first halves of different fingerprints
            order = np.lexsort((more, keys))
            same, other = self._neighbours(keys, more, order)
        first = np.ones(len(keys), bool)
        first[1:] = ~same | other
        starts = np.flatnonzero(first)
        self.at = order[starts]
        self.least = np.minimum.reduceat(ids[order], starts) if len(starts) else ids
        self.number = np.empty(len(keys), np.int64)
        self.number[order] = np.cumsum(first) - 1

    @staticmethod
    def _neighbours(keys: np.ndarray, more: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of neighbours: first halves are equal, second halves differ."""
        k, m = keys[order], more[order]
        return k[1:] == k[:-1], m[1:] != m[:-1]

    def removed(self, ids: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        """Which entries some document holds under a smaller id: another unit (`earlier`, by group), or one here."""
        return earlier[self.number] | (ids > self.least[self.number])


def _coded(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Different ids, and each id's number among them; a unit has few documents, so numbers are short."""
    known, number = np.unique(ids, return_inverse=True)
    return known.tobytes(), number.astype(np.uint16 if len(known) <= 65_536 else np.uint32)


def _decoded(table: pa.Table, keys: list[np.ndarray]) -> list[np.ndarray]:
    out = []
    for packed, ids, own in zip(table["least"].to_pylist(), table["ids"].to_pylist(), keys):
        number = np.frombuffer(packed, np.uint16 if len(packed) == 2 * len(own) else np.uint32)
        out.append(np.frombuffer(ids, "<i8")[number])
    return out


def _deal_phrases(schema: pa.Schema, parts: int, length: int, gram: int):
    """Each unit's different phrases with their trigger window and least id, dealt by the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                windows, keys, more, ids = _phrase_entries(row, length, gram)
                groups = Groups(keys, more, ids)
                by_window = np.argsort(windows[groups.at], kind="stable")
                at = groups.at[by_window]
                if len(at):
                    known, number = _coded(groups.least[by_window])
                    columns = {
                        "keys": (keys[at], _plain),
                        "more": (more[at], _plain),
                        "least": (number, _plain),
                        "windows": (windows[at], _packed),
                    }
                    yield _dealt(windows[at], columns, row["unit"], parts, schema, ids=known)

    return run


def _halves(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64)


def _phrase_answers(schema: pa.Schema):
    """For one part, of each entry: 1 if its window has more than one phrase, 2 if another unit has a smaller id."""

    def run(table: pa.Table) -> pa.Table:
        windows = [_unpacked(x, np.uint64) for x in table["windows"].to_pylist()]
        ids = np.concatenate(_decoded(table, windows))
        groups = Groups(_halves(table["keys"]), _halves(table["more"]), ids)
        _, inverse, counts = np.unique(np.concatenate(windows)[groups.at], return_inverse=True, return_counts=True)
        earlier = groups.least[groups.number] < ids
        flags = (counts[inverse] > 1)[groups.number].astype(np.uint8) + 2 * earlier.astype(np.uint8)
        own = np.split(flags.astype(np.uint8), np.cumsum([len(x) for x in windows])[:-1])
        out = {"part": table["part"], "unit": table["unit"], "flags": [x.tobytes() for x in own]}
        return pa.table(out, schema=schema)

    return run


def _decided(schema: pa.Schema, parts: int, length: int, gram: int):
    """What the dictionary removes, as runs of strings, and the regions with strings that are still open.

    A mark per byte of these regions tells which strings are open.
    """

    def run(regions: pa.Table, replies: pa.Table) -> pa.Table:
        rows = []
        for row in regions.to_pylist():
            windows, keys, more, ids = _phrase_entries(row, length, gram)
            groups = Groups(keys, more, ids)
            by_window = np.argsort(windows[groups.at], kind="stable")
            flags = np.empty(len(by_window), np.uint8)
            flags[by_window] = _flags(replies, windows[groups.at[by_window]], parts)
            removed = groups.removed(ids, flags > 1)
            still = (flags & 1 > 0)[groups.number] & ~removed
            docs, places = _region_numbers(row)
            sizes = np.frombuffer(row["sizes"], "<i8")
            gone, kept, marks, texts, done = [], [], [], [], 0
            for first, _, parsed in _parsed_regions(row, length, gram):
                n, bytes_here = len(parsed.triggers), int(parsed.ends[-1])
                settled, opened = np.zeros(bytes_here, bool), np.zeros(bytes_here, bool)
                settled[: len(parsed.valid)] = parsed.strings_of(removed[done : done + n])
                opened[: len(parsed.valid)] = parsed.strings_of(still[done : done + n])
                opened &= ~settled
                done += n
                starts, ends = _runs(settled)
                region = np.searchsorted(parsed.ends, starts, "right")
                shift = places[region + first] - parsed.starts[region]
                gone.append(np.stack([docs[region + first], starts + shift, ends + shift + length - 1]))
                has_open = np.add.reduceat(opened, parsed.starts) > 0
                inside = np.repeat(has_open, parsed.ends - parsed.starts)
                kept.append(np.flatnonzero(has_open) + first)
                marks.append(opened[inside])
                texts.append(parsed.buffer[inside].tobytes())
            kept = np.concatenate(kept)
            gone = np.concatenate(gone, axis=1).astype("<u4")
            rows.append(
                {
                    "unit": row["unit"],
                    "ids": row["ids"],
                    **_region_columns(docs[kept], places[kept], sizes[kept]),
                    "text": zstandard.compress(b"".join(texts), 3),
                    "open": zstandard.compress(np.packbits(np.concatenate(marks)).tobytes(), 1),
                    "gone": zstandard.compress(gone.tobytes(), 1),
                }
            )
        return pa.Table.from_pylist(rows, schema=schema)

    return run


def _suffixes(row: dict, length: int) -> tuple[np.ndarray, ...]:
    """Open strings of a unit: place in its region bytes, both halves of the fingerprint, id."""
    text, sizes = _opened(row)
    state = np.unpackbits(np.frombuffer(zstandard.decompress(row["open"]), np.uint8))
    ids = _region_ids(row)
    places, prints, more, owners = ([np.zeros(0, kind)] for kind in (np.int64, np.uint64, np.uint64, np.int64))
    begin = 0
    for first, buffer, own in _buffers(text, sizes):
        at = np.flatnonzero(state[begin : begin + len(buffer)])
        places.append(at + begin)
        prints.append(Fingerprints(buffer).at(at, length))
        more.append(Fingerprints(buffer, 1).at(at, length))
        owners.append(ids[first + np.searchsorted(np.cumsum(own), at, "right")])
        begin += len(buffer)
    return tuple(map(np.concatenate, (places, prints, more, owners)))


def _deal_suffixes(schema: pa.Schema, parts: int, length: int):
    """Each unit's different open strings with their least id, by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, keys, more, ids = _suffixes(row, length)
                groups = Groups(keys, more, ids)
                at = groups.at
                if len(at):
                    known, number = _coded(groups.least)
                    columns = {"keys": (keys[at], _packed), "more": (more[at], _plain), "least": (number, _plain)}
                    yield _dealt(keys[at], columns, row["unit"], parts, schema, ids=known)

    return run


def _suffix_answers(schema: pa.Schema):
    """For one part, of each entry: 1 if another unit holds the string under a smaller id."""

    def run(table: pa.Table) -> pa.Table:
        keys = [_unpacked(x, np.uint64) for x in table["keys"].to_pylist()]
        ids = np.concatenate(_decoded(table, keys))
        groups = Groups(np.concatenate(keys), _halves(table["more"]), ids)
        earlier = (groups.least[groups.number] < ids).astype(np.uint8)
        own = np.split(earlier, np.cumsum([len(x) for x in keys])[:-1])
        out = {"part": table["part"], "unit": table["unit"], "flags": [x.tobytes() for x in own]}
        return pa.table(out, schema=schema)

    return run


def _spans(schema: pa.Schema, parts: int, length: int):
    """Removed bytes of each document of a unit, as runs: those of the dictionary and those of the suffixes."""

    def run(regions: pa.Table, replies: pa.Table) -> pa.Table:
        rows = []
        for row in regions.to_pylist():
            at_byte, keys, more, ids = _suffixes(row, length)
            groups = Groups(keys, more, ids)
            removed = groups.removed(ids, _flags(replies, keys[groups.at], parts) > 0) if len(keys) else keys > 0
            docs, places = _region_numbers(row)
            sizes = np.frombuffer(row["sizes"], "<i8")
            gone = np.zeros(int(sizes.sum()), bool)
            gone[at_byte[removed]] = True
            starts, ends = _runs(gone)
            bounds = np.cumsum(sizes)
            region = np.searchsorted(bounds, starts, "right")
            shift = places[region] - (bounds - sizes)[region] if len(region) else 0
            open_spans = np.stack([docs[region], starts + shift, ends + shift + length - 1]) if len(region) else np.zeros((3, 0), np.int64)
            settled = np.frombuffer(zstandard.decompress(row["gone"]), "<u4").reshape(3, -1)
            both = np.concatenate([settled, open_spans], axis=1).astype("<i8")
            rows.append({"unit": row["unit"], **dict(zip(("docs", "starts", "ends"), (x.tobytes() for x in both)))})
        return pa.Table.from_pylist(rows, schema=schema)

    return run


def _cut(schema: pa.Schema):
    def run(units: pa.Table, spans: pa.Table) -> pa.Table:
        rows = []
        for row in units.to_pylist():
            text, sizes = _opened(row)
            ends = np.cumsum(sizes)
            docs, starts, stops = (_merged(spans, c, "<i8") for c in ("docs", "starts", "ends"))
            gone = np.zeros(len(text), bool)
            base = (ends - sizes)[docs]
            for a, b in zip((base + starts).tolist(), (base + stops).tolist()):
                gone[a:b] = True
            raw = np.frombuffer(text, np.uint8)
            for i, a, b in zip(row["ids"], (ends - sizes).tolist(), ends.tolist()):
                mask = gone[a:b]
                firsts, lasts = _runs(mask)
                kept = raw[a:b][~mask].tobytes()
                rows.append(
                    {
                        "row": i,
                        "n_bytes": b - a,
                        "n_removed": int(mask.sum()),
                        "span_starts": firsts,
                        "span_ends": lasts,
                        "kept": kept,
                        "kept_sha256": hashlib.sha256(kept).hexdigest(),
                    }
                )
        return pa.Table.from_pylist(rows, schema=schema)

    return run


def find_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    screen_gram: int = SCREEN_GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """(row, n_bytes, n_removed, span_starts, span_ends, kept, kept_sha256) of every document.

    `row` is a struct of `id` and the `carried` columns, in which names cannot clash: they are named c0, c1, ...
    """
    extra = [docs[c].alias(f"c{i}") for i, c in enumerate(carried)]
    source = docs.select(
        F.struct(docs[id_col].alias("id"), *extra).alias("row"), F.coalesce(docs[text_col], F.lit("")).alias("text")
    )
    kind = source.schema["row"].dataType
    field = StructField
    unit_row = StructType(
        [field("unit", LongType()), field("ids", ArrayType(kind)), field("sizes", BinaryType()), field("text", BinaryType())]
    )
    units = stage(source.mapInArrow(_pack(to_arrow_schema(unit_row)), unit_row), "units")
    volume = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-volume // PART_BYTES))

    def exchanged(rows: DataFrame, sent: list[str], returned: list[StructField], deal, answer) -> DataFrame:
        """Sends entries to the task of their part and returns the answers by unit."""
        out = StructType(
            [field("part", IntegerType()), field("unit", LongType()), *(field(c, BinaryType()) for c in sent)]
        )
        back = StructType(returned)
        dealt = rows.mapInArrow(deal(to_arrow_schema(out)), out)
        return dealt.groupBy("part").applyInArrow(answer(to_arrow_schema(back)), back)

    flags = [field("part", IntegerType()), field("unit", LongType()), field("flags", BinaryType())]

    def with_answers(rows: DataFrame, answers: DataFrame, function, out: StructType, label: str) -> DataFrame:
        joined = rows.groupBy("unit").cogroup(answers.groupBy("unit"))
        return stage(joined.applyInArrow(function(to_arrow_schema(out)), out), label)

    def region_row(*more: str) -> StructType:
        columns = ("ids", "docs", "places", "sizes", "text", *more)
        return StructType([field("unit", LongType()), *(field(c, BinaryType()) for c in columns)])

    span_row = StructType([field("unit", LongType()), *(field(c, BinaryType()) for c in ("docs", "starts", "ends"))])
    final_row = StructType(
        [
            field("row", kind),
            field("n_bytes", LongType()),
            field("n_removed", LongType()),
            field("span_starts", ArrayType(LongType())),
            field("span_ends", ArrayType(LongType())),
            field("kept", BinaryType()),
            field("kept_sha256", StringType()),
        ]
    )

    shared = exchanged(
        units,
        ["keys", "twice"],
        [field("unit", LongType()), field("keys", BinaryType())],
        lambda s: _deal_windows(s, parts, length, screen_gram),
        _shared_windows,
    )
    regions = with_answers(units, shared, lambda s: _regions(s, length, screen_gram), region_row(), "regions")
    held = exchanged(
        regions, ["keys", "more", "least", "windows", "ids"], flags, lambda s: _deal_phrases(s, parts, length, gram), _phrase_answers
    )
    decided = with_answers(
        regions, held, lambda s: _decided(s, parts, length, gram), region_row("open", "gone"), "decided"
    )
    first = exchanged(
        decided, ["keys", "more", "least", "ids"], flags, lambda s: _deal_suffixes(s, parts, length), _suffix_answers
    )
    spans = with_answers(decided, first, lambda s: _spans(s, parts, length), span_row, "spans")
    return units.groupBy("unit").cogroup(spans.groupBy("unit")).applyInArrow(_cut(to_arrow_schema(final_row)), final_row)


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_removed, span_starts, span_ends, kept, kept_sha256) of every document.

    Spans are byte positions in the input text; `kept` has the remaining bytes.
    """
    found = find_repeats(docs, length, id_col=id_col, text_col=text_col)
    return found.select(F.col("row.id").alias(id_col), *[c for c in found.columns if c != "row"])


def without_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents with the remaining text and all other columns as they were.

    A letter of which a cut takes some bytes goes as a whole. A text of which nothing is left stays, empty.
    """
    others = tuple(c for c in docs.columns if c != text_col)
    found = find_repeats(docs, length, id_col=id_col, text_col=text_col, carried=others)
    schema = StructType([StructField("row", found.schema["row"].dataType), StructField("text", StringType())])
    arrow = to_arrow_schema(schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [x.decode("utf-8", "ignore") for x in part.column("kept").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(texts, arrow.field("text").type)], schema=arrow)

    texts = found.select("row", "kept").mapInArrow(run, schema)
    places = {c: F.col(f"row.c{i}") for i, c in enumerate(others)} | {text_col: F.col("text")}
    return texts.select(*[places[c].alias(c) for c in docs.columns])
