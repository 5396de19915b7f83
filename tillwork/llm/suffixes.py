"""Byte strings that repeat across documents, by a suffix sort that compares hashes.

Of any string of ``length`` bytes the least hash of its grams picks an anchor, the same one
wherever the string stands. Only suffixes at anchors whose gram stands in several documents
are sorted, so they come in runs of one gram. A run is merge-sorted; two suffixes are compared
by a binary search for their common extension over prefix hashes. What the sort puts side by
side is verified byte by byte. Runs of a very common gram are sorted in parts and merged by a
shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.words import Rolling, mixed, signed
from tillwork.llm.workspace import Workspace, map_batches
from tillwork.operators.hot import spread

# Contexts of one gram that are sorted at once; more are dealt to several runs.
RUN = 50_000
# Contexts for which a task sorts several runs together.
_CHUNK = 16_000
# Text that a task works on at once, and that is hashed together.
_BYTES = 8 * 2**20
_TOGETHER = 2**16
# A random number for each byte, so that hashes of like strings are unlike.
_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _codes(raw: bytes) -> np.ndarray:
    return _CODES[np.frombuffer(raw, np.uint8)]


def _owners(hashes: np.ndarray, span: int) -> np.ndarray:
    """The anchor of each ``span`` consecutive hashes: the place of the least, the first of equals.

    Places stand in the low bits, so that a minimum over doubling widths tells them; what is
    left of a hash orders well enough, and alike wherever the hashes are the same.
    """
    bits = 20
    low, step = np.uint64(2**bits - 1), 2**bits - span
    out = []
    for start in range(0, len(hashes) - span + 1, step):
        part = hashes[start : start + step + span - 1]
        least = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: width - span], least[span - width :])
        out.append((least & low).astype(np.int64) + start)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _firsts(values: np.ndarray) -> np.ndarray:
    """Places of the first of equal neighbours."""
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]][: len(values)])


def _identity(raw: bytes) -> tuple[int, int]:
    """128 bits of a byte string, as two signed longs."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(raw), np.int64).tolist())


def _groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about ``_TOGETHER`` bytes; a longer one is alone."""
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > _TOGETHER:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def _anchors(raws: list[bytes], rolling: Rolling, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Each text's anchors in order, from one pass over all texts.

    Returns the text, the first and the last of the strings that have the anchor, its place,
    all counted in that text, and the hash of its gram.
    """
    ends = np.cumsum([len(r) for r in raws])
    hashes = rolling.windows(_codes(b"".join(raws)), gram)
    owners = _owners(hashes, length - gram + 1)
    inside = np.ones(len(owners), bool)
    for end in ends.tolist():  # no string goes on in the next text
        inside[max(end - length + 1, 0) : end] = False
    starts = np.flatnonzero(inside)
    owners = owners[starts]
    first = _firsts(owners)
    last = np.r_[first[1:], len(owners)][: len(first)] - 1
    at = owners[first]
    text = np.searchsorted(ends, at, side="right")
    begin = np.r_[0, ends][text]
    return text, starts[first] - begin, starts[last] - begin, at - begin, signed(hashes)[at]


def _anchored(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Identity, size and the hashes of the anchor grams of each text."""

    def make():
        rolling = Rolling(gram)

        def convert(rows):
            raws = rows["raw"]
            sizes = [len(r) for r in raws]
            grams, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for start, end in _groups(sizes):
                text, *_, of_gram = _anchors(raws[start:end], rolling, length, gram)
                order = np.lexsort((of_gram, text))
                text, of_gram = text[order], of_gram[order]
                new = np.r_[True, (text[1:] != text[:-1]) | (of_gram[1:] != of_gram[:-1])]
                new = new[: len(text)]
                grams.append(of_gram[new])
                counts.append(np.bincount(text[new], minlength=end - start))
            keys = [_identity(raw) for raw in raws]
            return {
                "doc_id": rows["doc_id"],
                "x": rows["x"],
                "k1": [k[0] for k in keys],
                "k2": [k[1] for k in keys],
                "n_bytes": sizes,
                "grams": _listed(np.concatenate(grams), np.concatenate(counts), pa.int64()),
            }

        return convert

    schema = "doc_id long, x long, k1 long, k2 long, n_bytes long, grams array<long>"
    return map_batches(docs, schema, make, _BYTES)


def _listed(flat: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column of consecutive parts of ``flat``."""
    ends = np.r_[0, np.cumsum(sizes)]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def _contexts(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """What lies around each anchor whose gram is in ``repeated``.

    A context is all the strings of ``length`` bytes that have the anchor, taken together.
    Its identity counts the anchor's offset in it. A text has one row for each, with its places.
    """

    def make():
        rolling = Rolling(gram)

        def convert(rows):
            held = [
                row
                for row in zip(*[rows[n] for n in ("no", "doc_id", "k1", "k2", "raw", "repeated")], strict=True)
                if _identity(row[4]) == row[2:4]  # not another text of equal hash
            ]
            none = np.empty(0, np.int64)
            out = {n: [none] for n in ("no", "doc_id", "gram", "off", "places", "sizes")}
            contexts, identities = [], []
            for start, end in _groups([len(row[4]) for row in held]):
                part = held[start:end]
                raws = [row[4] for row in part]
                text, first, last, at, of_gram = _anchors(raws, rolling, length, gram)
                # A gram is repeated for all texts or none.
                repeated = np.concatenate([np.array(row[5], np.int64) for row in part])
                wanted = np.isin(of_gram, repeated)
                text, first, last, at, of_gram = [v[wanted] for v in (text, first, last, at, of_gram)]
                off = at - first
                slots: dict[tuple[int, bytes], int] = {}
                slot = []
                for t, a, b, p in zip(*[v.tolist() for v in (text, first, last + length, off)], strict=True):
                    context = raws[t][a:b]
                    key = xxhash.xxh3_128_digest(context, p)
                    n = len(slots)
                    own = slots.setdefault((t, key), n)
                    slot.append(own)
                    if own == n:
                        contexts.append(context)
                        identities.append(key)
                slot = np.array(slot, np.int64)
                new = np.unique(slot, return_index=True)[1]
                text = text[new]
                out["no"].append(np.array([row[0] for row in part], np.int64)[text])
                out["doc_id"].append(np.array([row[1] for row in part], np.int64)[text])
                out["gram"].append(of_gram[new])
                out["off"].append(off[new])
                out["places"].append(first[np.argsort(slot, kind="stable")])
                out["sizes"].append(np.bincount(slot))
            flat = {n: np.concatenate(v) for n, v in out.items()}
            c1, c2 = np.frombuffer(b"".join(identities), np.int64).reshape(-1, 2).T
            places = _listed(flat.pop("places"), flat.pop("sizes"), pa.int32())
            return flat | {"c1": c1, "c2": c2, "context": contexts, "places": places}

        return convert

    schema = (
        "no long, doc_id long, gram long, c1 long, c2 long, off int, context binary, "
        "places array<int>"
    )
    return map_batches(texts, schema, make, _BYTES)


class Strings:
    """Byte strings laid end to end, with prefix hashes that compare any parts of them."""

    def __init__(self, parts: list[bytes]):
        self.starts = np.cumsum([0] + [len(p) for p in parts])
        self.raw = np.frombuffer(b"".join(parts), np.uint8)
        rolling = Rolling(303)
        self.sums = rolling.sums(_CODES[self.raw])
        self.inverses = rolling.inverses
        padded = np.r_[self.raw, np.zeros(8, np.uint8)]
        windows = np.lib.stride_tricks.sliding_window_view(padded, 8)
        # The eight bytes from each place on, as a number that orders like them.
        self.heads = windows.reshape(-1).view(">u8").astype(np.uint64)

    def _hash(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[at + size] - self.sums[at]) * self.inverses[at]

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The length of the common extension from ``a`` and ``b``, up to ``most``."""
        whole = self._hash(a, most) == self._hash(b, most)
        low = np.where(whole, most, 0).astype(np.int64)
        high = np.where(whole, most, most - 1).astype(np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_] + 1) // 2
            x, y = a[open_], b[open_]
            same = self._hash(x, middle) == self._hash(y, middle)
            low[open_[same]] = middle[same]
            high[open_[~same]] = middle[~same] - 1

    def less(self, a, a_end, b, b_end, or_equal: np.ndarray) -> np.ndarray:
        """Whether the string from ``a`` to ``a_end`` comes before that of ``b``.

        Eight bytes settle most; the common extension of the others is searched for.
        """
        x, y = self.heads[a], self.heads[b]
        out = x < y
        rest = np.flatnonzero((x == y) | (a_end - a < 8) | (b_end - b < 8))
        if not len(rest):
            return out
        a, b, or_equal = a[rest], b[rest], or_equal[rest]
        n, m = a_end[rest] - a, b_end[rest] - b
        most = np.minimum(n, m)
        k = self.common(a, b, most)
        inside = k < most
        x = self.raw[np.where(inside, a + k, 0)]
        y = self.raw[np.where(inside, b + k, 0)]
        out[rest] = np.where(inside, x < y, (n < m) | ((n == m) & or_equal))
        return out

    def words(self, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The strings as rows of big-endian words, zeros behind, for an exact comparison."""
        size = end - at
        columns = -(-int(size.max(initial=1)) // 8) * 8
        padded = np.r_[self.raw, np.zeros(columns, np.uint8)]
        out = np.lib.stride_tricks.sliding_window_view(padded, columns)[at]
        if (size < columns).any():
            out[np.arange(columns) >= size[:, None]] = 0
        return out.view(">u8")

    def sort(self, at: np.ndarray, end: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The order of the strings by group and then bytes: a merge sort of every group.

        ``group`` does not decrease. The order that the hashes give is checked byte by byte;
        if a collision has misled it, the bytes are sorted instead.
        """
        first = _firsts(group)
        size = np.diff(np.r_[first, len(group)])
        of = np.repeat(np.arange(len(first)), size)
        base, ends = first[of], (first + size)[of]
        order, width = np.arange(len(group)), 1
        while width < size.max(initial=0):
            place = np.flatnonzero(size[of] > width)
            start, until = base[place], ends[place]
            run = (place - start) // width
            other = start + (run ^ 1) * width
            low = np.minimum(other, until)
            high, begin = np.minimum(other + width, until), low
            item = order[place]
            right = (run & 1).astype(bool)  # of equal strings, those of the left run come first
            low = low.copy()
            while len(open_ := np.flatnonzero(low < high)):
                middle = (low[open_] + high[open_]) // 2
                x, y = order[middle], item[open_]
                before = self.less(at[x], end[x], at[y], end[y], right[open_])
                low[open_[before]] = middle[before] + 1
                high[open_[~before]] = middle[~before]
            pair = start + (run & ~1) * width
            merged = order.copy()
            merged[pair + (place - start - run * width) + (low - begin)] = item
            order, width = merged, 2 * width
        words = self.words(at[order], end[order])
        if _ascending(words, group):
            return order
        return np.lexsort((*self.words(at, end).T[::-1], group))


def _ascending(words: np.ndarray, group: np.ndarray) -> bool:
    above, below = words[:-1], words[1:]
    differ = above != below
    column = differ.argmax(axis=1)
    row = np.arange(len(column))
    fine = (above[row, column] <= below[row, column]) | (group[1:] != group[:-1])
    return bool(fine.all())


def _neighbours(strings: Strings, at, end, group, order) -> np.ndarray:
    """The longest common extension of each string with any other of its group."""
    a, b = order[:-1], order[1:]
    n = np.where(
        group[a] == group[b],
        strings.common(at[a], at[b], np.minimum(end[a] - at[a], end[b] - at[b])),
        0,
    )
    out = np.zeros(len(order), np.int64)
    out[a] = n
    out[b] = np.maximum(out[b], n)
    return out


def _repeats(
    rows: dict[str, np.ndarray | list[bytes]], length: int, gram: int
) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """The strings of each context that another of its run holds for a smaller document.

    Returns the contexts, the first and one past the last byte they cover. For runs that are a
    part of a gram's, also each string that has none: the contexts and the starts.
    """
    strings = Strings(rows["context"])
    starts, ends = strings.starts[:-1], strings.starts[1:]
    off, doc = rows["off"].astype(np.int64), rows["doc_id"]
    run, parts = rows["run"], rows["parts"]
    # All suffixes of a run begin with its gram, so they are compared behind it.
    behind = starts + off + gram
    order = strings.sort(behind, ends, run)
    reach = gram + _neighbours(strings, behind, ends, run, order)
    # A string that starts s bytes into its context goes on for length - (off - s) behind the
    # anchor, where it must agree with a neighbour.
    count = np.clip(np.minimum(ends - starts - length + 1, off + reach - length + 1), 0, None)
    owner = np.repeat(np.arange(len(count)), count)
    s = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    # Equal strings have their anchor at the same place.
    group = run[owner] * (length + 1) + (off[owner] - s)
    by_group = np.argsort(group, kind="stable")
    owner, s, group = owner[by_group], s[by_group], group[by_group]
    at = starts[owner] + s
    order = strings.sort(at, at + length, group)
    owner, s, group = owner[order], s[order], group[order]
    gone = np.zeros(len(owner), bool)
    if len(owner):
        words = strings.words(at[order], at[order] + length)
        new = np.r_[True, (words[1:] != words[:-1]).any(axis=1) | (group[1:] != group[:-1])]
        least = np.minimum.reduceat(doc[owner], np.flatnonzero(new))
        gone = least[np.cumsum(new) - 1] < doc[owner]
    low = np.full(len(doc), np.iinfo(np.int64).max)
    high = np.full(len(doc), -1)
    np.minimum.at(low, owner[gone], s[gone])
    np.maximum.at(high, owner[gone], s[gone])
    # A context is so short that its removed strings overlap.
    cut = np.flatnonzero(high >= 0)
    several = np.flatnonzero(parts > 1)
    count = (ends - starts)[several] - length + 1
    at = np.repeat(several, count)
    s_at = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    known = np.isin(at * _MOST + s_at, owner[gone] * _MOST + s[gone])
    return (cut, low[cut], high[cut] + length), (at[~known], s_at[~known])


# More than a context has bytes.
_MOST = 2**10
_SORTED = {"no": pa.int64(), "spans": pa.list_(pa.int64()), "doc_id": pa.int64(), "string": pa.binary()}
# A span is one long: its first byte, and one past the last in the low half.
_HALF = 32


def _late(rows: dict[str, np.ndarray]) -> np.ndarray:
    """Whether an equal context of the same run stands in an earlier document."""
    key = rows["c1"] + rows["run"] * np.int64(0x9E3779B97F4A7C1)
    order = np.argsort(key, kind="stable")
    same = [rows[n][order] for n in ("c1", "c2", "run")]
    new = np.r_[True, np.any([v[1:] != v[:-1] for v in same], axis=0)]
    doc = rows["doc_id"][order]
    least = np.minimum.reduceat(doc, np.flatnonzero(new))
    out = np.empty(len(order), bool)
    out[order] = least[np.cumsum(new) - 1] < doc
    return out


def _sorter(length: int, gram: int, chunk: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From contexts in order of gram and part to what goes of them, whole runs at a time."""
    schema = pa.schema(list(_SORTED.items()))

    def found(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        names = ("gram", "part", "parts", "doc_id", "off", "c1", "c2")
        rows = {n: table.column(n).to_numpy() for n in names}
        keys = np.array([rows["gram"], rows["part"]])
        rows["run"] = np.cumsum(np.r_[False, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
        # Of equal contexts those in later documents go as a whole; the others are sorted.
        late = _late(rows)
        left = np.bincount(rows["run"][~late], minlength=len(late))[rows["run"]]
        own = np.flatnonzero(~late & ((left > 1) | (rows["parts"] > 1)))
        late = np.flatnonzero(late)
        whole = table.column("size").to_numpy()[late].astype(np.int64)
        none = np.empty(0, np.int64)
        cut, low, high, open_, start = [none] * 5
        contexts = []
        if len(own):
            contexts = table.column("context").take(pa.array(own)).to_pylist()
            (cut, low, high), (open_, start) = _repeats(
                {n: rows[n][own] for n in ("run", "parts", "doc_id", "off")} | {"context": contexts},
                length,
                gram,
            )
        strings = [contexts[i][a : a + length] for i, a in zip(open_.tolist(), start.tolist(), strict=True)]
        at = np.concatenate([late, own[cut], own[open_]])
        low = np.concatenate([np.zeros(len(late), np.int64), low, start])
        high = np.concatenate([whole, high, start + length])
        of = table.select(["no", "doc_id", "places"]).take(pa.array(at)).combine_chunks()
        places = of.column("places").combine_chunks()
        sizes = places.value_lengths().to_numpy()
        flat = places.flatten().to_numpy().astype(np.int64)
        spans = (flat + np.repeat(low, sizes) << _HALF) | (flat + np.repeat(high, sizes))
        return pa.RecordBatch.from_arrays(
            [
                of.column("no").combine_chunks(),
                _listed(spans, sizes, pa.int64()),
                of.column("doc_id").combine_chunks(),
                pa.array([None] * (len(at) - len(strings)) + strings, pa.binary()),
            ],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n += batch.num_rows
            if n < chunk:
                continue
            table = pa.Table.from_batches(held)
            keys = np.array([table.column("gram").to_numpy(), table.column("part").to_numpy()])
            # The last run may go on in the next batch.
            ends = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            if len(ends):
                cut = int(ends[-1])
                yield found(table.slice(0, cut).to_batches())
                held = table.slice(cut).to_batches()
                n -= cut
        if held:
            yield found(held)

    return run


def _without(raw: bytes, spans: np.ndarray) -> tuple[int, bytes]:
    """The number of runs that ``spans`` make together, and the bytes outside them."""
    spans = np.sort(spans)
    first, end = spans >> _HALF, np.maximum.accumulate(spans & (2**_HALF - 1))
    apart = first[1:] > end[:-1]
    gaps = zip(np.r_[0, end[:-1][apart], end[-1]].tolist(), [*first[np.r_[True, apart]].tolist(), len(raw)], strict=True)
    return int(apart.sum()) + 1, b"".join([raw[a:b] for a, b in gaps])


def _cut(docs: DataFrame) -> DataFrame:
    """Texts without the bytes that ``marks`` cover."""

    def make():
        def convert(rows):
            out = {"doc_id": rows["doc_id"], "n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
            for raw, marks in zip(rows["raw"], rows["marks"], strict=True):
                own = _identity(raw) if marks else None
                mine = [m["spans"] for m in marks or () if (m["k1"], m["k2"]) == own]
                if not mine:
                    runs, kept = 0, raw
                elif any(spans is None for spans in mine):  # a copy as a whole
                    runs, kept = 1, b""
                else:
                    runs, kept = _without(raw, np.concatenate([np.array(m, np.int64) for m in mine]))
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(len(raw) - len(kept))
                out["n_spans"].append(runs)
                out["kept"].append(kept)
            return out

        return convert

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return map_batches(docs, schema, make, _BYTES)


def remove_repeated_bytes(docs: DataFrame, length: int = 50, gram: int = 18) -> DataFrame:
    """Each text without the bytes of strings that also start in an earlier document.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A byte of a text's UTF-8
    form goes if a string of ``length`` bytes over it also starts in a document with a smaller
    ``doc_id``; all strings are judged on the input and lie within one row. Returns ``doc_id,
    n_bytes, n_removed, n_spans, kept``, one row for each input row: ``n_spans`` counts the
    maximal runs of removed bytes, ``kept`` are the others put together, which may break a
    character. ``gram`` is the number of bytes that an anchor is picked by; it changes the
    work, not the result.

    A missing or empty text has no bytes. A row without an id is returned whole and never
    makes others shorter. Rows that repeat an id do not count against each other; different
    texts under one id are judged one by one. Any number of rows may share a string or a whole
    text: copies are looked at once, equal contexts of a run once, and the strings around a
    very common gram are sorted in parts of about ``RUN`` contexts and merged by a shuffle.
    """
    if not 1 <= gram < length <= 255:
        raise ValueError("a gram is shorter than a string, and a string has 255 bytes at most")
    work = Workspace(docs.sparkSession)
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw"),
    ).withColumn("x", F.xxhash64("raw"))
    named = docs.filter("doc_id IS NOT NULL")

    rows = work.put(_anchored(named.filter(F.length("raw") >= length), length, gram))
    again = not rows.groupBy("doc_id", "x").count().filter("count > 1").isEmpty()
    # Copies of one text are looked at once, under the smallest id.
    texts = rows.groupBy("k1", "k2").agg(
        F.min("doc_id").alias("doc_id"), F.first("x").alias("x"), F.first("grams").alias("grams")
    )
    texts = work.put(texts.withColumn("no", F.monotonically_increasing_id()))
    keys = work.put(texts.select("no", "doc_id", "x", "k1", "k2"))
    copies = work.put(
        rows.select("doc_id", "x", "k1", "k2")
        .distinct()
        .join(keys.select("k1", "k2", F.col("doc_id").alias("first"), spread("k1", "k2")), ["k1", "k2"])
        .filter("first < doc_id")
        .select("doc_id", "x", "k1", "k2")
    )
    work.drop(rows)
    grams = texts.select("no", F.explode("grams").alias("gram"))
    shared = work.put(
        grams.groupBy("gram")
        .agg(F.count(F.lit(1)).alias("texts"))
        .filter("texts > 1")
        .select("gram")
    )
    repeated = grams.join(shared, "gram").groupBy("no")
    wanted = work.put(keys.join(repeated.agg(F.collect_list("gram").alias("repeated")), "no"))
    work.drop(texts, shared)
    # Rows that repeat both id and text are read once.
    once = named.groupBy("doc_id", "x").agg(F.first("raw").alias("raw")) if again else named
    contexts = work.put(_contexts(once.join(wanted, ["doc_id", "x"]), length, gram))
    work.drop(wanted)

    # At most one gram for each RUN contexts, so few enough to be sent to all tasks.
    hot = (
        contexts.groupBy("gram")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > RUN)
        .select("gram", F.ceil(F.col("n") / RUN).cast("long").alias("parts"))
    )
    dealt = (
        contexts.join(F.broadcast(hot), "gram", "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
        .withColumn("part", F.pmod(F.xxhash64("no", "c2"), "parts"))
        .withColumn("size", F.length("context"))
    )
    ordered = dealt.repartition("gram", "part").sortWithinPartitions("gram", "part")
    found = work.put(
        ordered.select(
            *["gram", "part", "parts", "no", "doc_id", "off", "c1", "c2", "size", "context", "places"]
        ).mapInArrow(
            _sorter(length, gram, _CHUNK), "no long, spans array<long>, doc_id long, string binary"
        )
    )
    work.drop(contexts)
    # The parts of a gram are merged: which string stands in an earlier document elsewhere.
    pending = found.filter("string IS NOT NULL")
    merged = pending.groupBy("string", spread("string")).agg(F.min("doc_id").alias("least"))
    elsewhere = pending.join(merged.select("string", "least"), "string").filter("least < doc_id")
    spans = (
        found.filter("string IS NULL")
        .select("no", "spans")
        .unionByName(elsewhere.select("no", "spans"))
        .select("no", F.explode("spans").alias("span"))
        .groupBy("no")
        .agg(F.collect_list("span").alias("spans"))
        .join(keys, "no")
        .select("doc_id", "x", "k1", "k2", "spans")
    )
    copies = copies.withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
    marks = work.put(
        spans.unionByName(copies)
        .groupBy("doc_id", "x")
        .agg(F.collect_list(F.struct("k1", "k2", "spans")).alias("marks"))
    )
    work.drop(found)
    marked = named.join(marks, ["doc_id", "x"], "left")
    unnamed = docs.filter("doc_id IS NULL").withColumn(
        "marks", F.lit(None).cast(marks.schema["marks"].dataType)
    )
    return _cut(marked.unionByName(unnamed).select("doc_id", "raw", "marks"))
