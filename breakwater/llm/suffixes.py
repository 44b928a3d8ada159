"""Removal of repeated byte strings by suffix arrays, built by linear grouping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breakwater.llm.tables import discard, keep
from breakwater.llm.vectors import _groups as groups

#: Bytes of a repeated string, and of the anchor strings by which repeats are looked up.
LENGTH, ANCHOR = 200, 51
#: Bytes of contexts sorted at once; contexts of one anchor beyond which windows are counted.
BLOCK, HOT = 1 << 19, 4096

_FACTOR = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def suffix_array(text: bytes) -> list[int]:
    """The starts of all suffixes in ascending order; a suffix that begins another is smaller.

    Valleys, places that are smaller than the place before and as suffixes smaller than the next, cut
    the text into strings. The text of these strings' ranks, some third as long, is sorted by linear
    grouping. That gives the order of the valleys, from which the order of all others follows: two
    passes put each suffix to its place by the one that begins behind its first byte.
    """
    n = len(text) + 1  # with an end smaller than all bytes
    codes = np.zeros(n, np.int64)
    codes[:-1] = np.frombuffer(text, np.uint8)
    codes[:-1] += 1
    steps = np.sign(np.diff(codes))
    at = np.where(steps != 0, np.arange(n - 1), n)
    at = np.minimum.accumulate(at[::-1])[::-1]  # the next place whose code differs from its neighbour's
    rises = np.r_[steps[at] > 0, True] if n > 1 else np.ones(1, bool)
    valleys = (np.flatnonzero(rises[1:] & ~rises[:-1]) + 1).tolist() or [0]  # the end is the last one
    symbols = (2 * codes + rises).astype(">u2").tobytes()
    strings = [symbols[2 * a : 2 * b + 2] for a, b in zip(valleys, [*valleys[1:], n - 1], strict=True)]
    ranks = {x: k for k, x in enumerate(sorted(set(strings)))}
    ordered = [valleys[k] for k in _grouped(np.array([ranks[x] for x in strings], np.int64))]

    ends = np.cumsum(np.bincount(codes, minlength=257))
    heads, tails = [0, *ends[:-1].tolist()], ends.tolist()
    out = [-1] * n
    for p, c in zip(reversed(ordered), codes[ordered[::-1]].tolist(), strict=True):
        tails[c] -= 1
        out[tails[c]] = p
    # By place, the code before it if that is larger as a suffix, or if it is smaller; else -1.
    falling = np.r_[-1, np.where(rises[:-1], -1, codes[:-1])].tolist()
    rising = np.r_[-1, np.where(rises[:-1], codes[:-1], -1)].tolist()
    for p in out:
        if p > 0 and (c := falling[p]) >= 0:
            out[heads[c]] = p - 1
            heads[c] += 1
    tails = ends.tolist()
    for p in reversed(out):
        if p > 0 and (c := rising[p]) >= 0:
            tails[c] -= 1
            out[tails[c]] = p - 1
    return out[1:]


def _grouped(codes: np.ndarray) -> list[int]:
    """The starts of all suffixes in ascending order, by linear grouping; the last code is the
    smallest and occurs once.

    Groups of suffixes, at first those of equal first code, are processed from the largest to
    the smallest. The suffixes of a group are followed to the previous smaller one; those that
    are reached extend their common prefix by the group's and move, by how often they are
    reached, to new groups above their own. Each group then is a Lyndon prefix, and one pass
    over the order found so far puts every suffix to the front of its group.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    first = np.r_[True, ranked[1:] != ranked[:-1]]
    starts = np.flatnonzero(first)
    group = np.empty(n, np.int64)
    group[order] = np.repeat(starts, np.diff(np.r_[starts, n]))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    sizes = np.zeros(n, np.int64)
    sizes[starts] = np.diff(np.r_[starts, n])
    at, place, group, sizes = order.tolist(), place.tolist(), group.tolist(), sizes.tolist()
    before = [-1] * n

    end = n
    while end > 1:
        own = group[at[end - 1]]
        members = sorted(at[own:end]) if end - own > 1 else at[own:end]
        reached: dict[int, int] = {}
        for i in members:
            p = i - 1
            while p >= 0 and group[p] >= own:
                p = before[p]
            before[i] = p
            if p >= 0:
                reached[p] = reached.get(p, 0) + 1
        end = own
        if not reached:
            continue
        times: dict[int, list[int]] = {}
        for p, k in reached.items():
            times.setdefault(k, []).append(p)
        for k in sorted(times, reverse=True):
            rising: dict[int, list[int]] = {}
            for p in times[k]:
                rising.setdefault(group[p], []).append(p)
            for low, some in rising.items():
                size = sizes[low]
                if len(some) == size:
                    continue
                to = low + size
                for p in some:
                    to -= 1
                    spot, other = place[p], at[to]
                    at[spot], place[other] = other, spot
                    at[to], place[p] = p, to
                sizes[low] = size - len(some)
                sizes[to] = len(some)
                for p in some:
                    group[p] = to

    done = [False] * n
    done[n - 1] = True
    at[0] = n - 1
    head = list(range(n))
    for k in range(n):
        p = at[k] - 1
        while p >= 0 and not done[p]:
            own = group[p]
            at[head[own]] = p
            head[own] += 1
            done[p] = True
            p = before[p]
    return at


def _grown(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size, fresh = 1 << max(12, n.bit_length()), []
        for f in (_FACTOR, pow(_FACTOR, -1, 1 << 64)):
            x = np.full(size, f, np.uint64)
            x[0] = 1
            fresh.append(np.multiply.accumulate(x))
        _powers[:] = fresh
    return _powers


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors(text: bytes, length: int = LENGTH, anchor: int = ANCHOR):
    """Runs of windows of ``length`` bytes that share their smallest anchor hash.

    Returns hash, first window, windows, and where in the run's context the anchor is (-1 if it
    is there more than once). Equal windows have equal hashes, wherever they are. A run is no
    longer than the places of an anchor in a window.
    """
    n, width = len(text), length - anchor + 1
    if n < length:
        return [np.zeros(0, np.int64)] * 4
    up, down = _grown(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    h = (sums[anchor:] - sums[:-anchor]) * down[: n - anchor + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    low = _least(h, width)
    new = np.r_[True, low[1:] != low[:-1]]
    start = np.flatnonzero(new)
    sizes = np.diff(np.r_[start, len(low)])
    if sizes.max() > width:
        long = np.arange(len(low)) - np.repeat(start, sizes)
        start = np.flatnonzero(long % width == 0)
        sizes = np.diff(np.r_[start, len(low)])
    own = low[start]
    spots = _spots(h, low, width)
    first = np.searchsorted(spots, start)
    place, more = np.full(len(start), -1), np.zeros(len(start), np.int64)
    for step in range(width):
        k = first + step
        ok = k < len(spots)
        p = spots[np.minimum(k, len(spots) - 1)]
        inside = ok & (p < start + sizes + width - 1)
        if not inside.any():
            break
        same = inside & (h[p] == own)
        place = np.where(same & (more == 0), p - start, place)
        more += same
    return own.view(np.int64), start, sizes, np.where(more == 1, place, -1)


def _spots(h: np.ndarray, low: np.ndarray, width: int) -> np.ndarray:
    """Places whose hash is the minimum of some window that holds them."""
    n = len(h)
    # The largest minimum of the windows that hold a place equals its hash if any does.
    padded = np.zeros(n + width - 1, np.uint64)
    padded[width - 1 : width - 1 + len(low)] = low
    return np.flatnonzero(h == ~_least(~padded, width))


def _runs(text: bytes):
    h, start, sizes, place = anchors(text)
    ends = start + sizes + LENGTH - 1
    x = [xxhash.xxh3_64_intdigest(text[a:b]) for a, b in zip(start.tolist(), ends.tolist(), strict=True)]
    return h, start, sizes, place, np.array(x, np.uint64).view(np.int64)


def _anchored(docs: DataFrame) -> DataFrame:
    """(key, h, start, size, place, x): a row for each run of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, columns = [], []
            for key, text in zip(batch.column("key"), batch.column("text"), strict=True):
                found = _runs(text.as_py().encode())
                keys += [key.as_py()] * len(found[0])
                columns.append(found)
            parts = [np.concatenate(c) for c in zip(*columns, strict=True)] if columns else []
            if keys:
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), *(pa.array(p, pa.int64()).cast(k) for p, k in zip(parts, kinds, strict=True))],
                    names=["key", "h", "start", "size", "place", "x"],
                )

    return docs.select("key", "text").mapInArrow(run, "key binary, h long, start int, size int, place int, x long")


def _common(a: bytes, b: bytes) -> int:
    """The length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def _trimmed(contexts: list[tuple]) -> list[tuple]:
    """Cuts from each context (id, bytes, copies, place) what no other one shares beside the
    anchor, as found from its neighbours in the order of what follows and of what precedes.
    Returns (id, first byte, bytes, copies); contexts too short for a window are left out."""
    if any(place < 0 for *_, place in contexts):
        return [(c, 0, data, copies) for c, data, copies, _ in contexts]
    reach = []
    for side in (
        [data[place:] for _, data, _, place in contexts],
        [data[:place][::-1] for _, data, _, place in contexts],
    ):
        most = [0] * len(side)
        order = sorted(range(len(side)), key=side.__getitem__)
        for i, j in zip(order, order[1:], strict=False):
            k = _common(side[i], side[j])
            most[i], most[j] = max(most[i], k), max(most[j], k)
        reach.append(most)
    out = []
    for (c, data, copies, place), right, left in zip(contexts, *reach, strict=True):
        if copies > 1:
            left, right = place, len(data) - place
        if left + right >= LENGTH:
            out.append((c, place - left, data[place - left : place + right], copies))
    return out


def repeated_windows(groups_: list[list[tuple]]) -> list[tuple[int, int, int]]:
    """Of contexts (id, bytes, copies, place), grouped by anchor, the bytes covered by windows
    that start elsewhere too: (id, from, to) in each context."""
    texts: dict[bytes, int] = {}
    copies: list[int] = []
    users: list[tuple[int, int, int]] = []
    for contexts in groups_:
        cut = _trimmed(contexts)
        times: dict[bytes, int] = {}
        for _, _, data, n in cut:
            times[data] = times.get(data, 0) + n
        for data, n in times.items():
            texts[data] = len(copies)
            copies.append(n)
        users += [(c, first, texts[data]) for c, first, data, _ in cut]
    if not copies:
        return []
    lengths = np.array([len(d) for d in texts])
    begins = np.r_[0, np.cumsum(lengths + 1)]
    joined = b"".join(d + b"\xff" for d in texts)  # \xff is in no UTF-8 text
    at = np.array(suffix_array(joined))
    of = np.searchsorted(begins, at, side="right") - 1
    ahead = begins[of] + lengths[of] - at
    at, of = at[ahead >= LENGTH], of[ahead >= LENGTH]
    equal = np.zeros(len(at), bool)
    where = at.tolist()
    same = np.fromiter(
        (joined[i : i + LENGTH] == joined[j : j + LENGTH] for i, j in zip(where, where[1:], strict=False)),
        bool,
        max(0, len(at) - 1),
    )
    equal[:-1] |= same
    equal[1:] |= same
    equal |= np.array(copies)[of] > 1
    windows = np.sort(at[equal])
    spans: dict[int, list[tuple[int, int]]] = {}
    if len(windows):
        owner = np.searchsorted(begins, windows, side="right") - 1
        cut = np.r_[True, (np.diff(windows) > 1) | (np.diff(owner) > 0)]
        low = np.flatnonzero(cut)
        high = np.r_[low[1:], len(windows)] - 1
        for o, a, b in zip(owner[low].tolist(), windows[low].tolist(), windows[high].tolist(), strict=True):
            spans.setdefault(o, []).append((a - int(begins[o]), b - int(begins[o]) + LENGTH))
    return [(c, first + a, first + b) for c, first, k in users for a, b in spans.get(k, ())]


def _contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, x, n, place, hot, size, context) of the runs wanted: key, doc_id, runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column("text")[row].as_py().encode()
                runs = batch.column("runs")[row].as_py()
                data = [text[r["start"] : r["start"] + r["size"] + LENGTH - 1] for r in runs]
                table = pa.Table.from_pylist(runs).drop_columns(["start"])
                table = table.append_column("context", pa.array(data, pa.binary()))
                order = ["h", "x", "n", "place", "hot", "size", "context"]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.binary()]
                table = table.select(order).cast(pa.schema(list(zip(order, kinds, strict=True))))
                yield from table.combine_chunks().to_batches()

    joined = docs.join(wanted, (F.col("doc_id").eqNullSafe(F.col("_doc"))) & (F.col("key") == F.col("_key")))
    got = joined.select("text", "runs").mapInArrow(
        run, "h long, x long, n long, place int, hot boolean, size int, context binary"
    )
    return keep(got.dropDuplicates(["h", "x"]), "contexts")


def _sorted(contexts: DataFrame) -> DataFrame:
    """(h, x, low, high): repeated bytes of contexts, by suffix arrays of blocks of anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names, size = [], [], 0

        def found() -> pa.RecordBatch:
            spans = repeated_windows(held)
            columns = [[names[c][0] for c, _, _ in spans], [names[c][1] for c, _, _ in spans]]
            columns += [[a for _, a, _ in spans], [b for _, _, b in spans]]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["h", "x", "low", "high"]
            )

        for group in groups(batches, ("h",)):
            contexts_ = []
            columns = (group.column(c).to_pylist() for c in ("h", "x", "n", "place", "context"))
            for h, x, n, place, data in zip(*columns, strict=True):
                contexts_.append((len(names), data, n, place))
                names.append((h, x))
                size += len(data)
            held.append(contexts_)
            if size >= BLOCK:
                yield found()
                held, names, size = [], [], 0
        if held:
            yield found()

    few = contexts.where("NOT hot").select("h", "x", "n", "place", "context")
    dealt = few.repartition("h").sortWithinPartitions("h", "x")
    return dealt.mapInArrow(run, "h long, x long, low int, high int")


def _counted(contexts: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The same for anchors of very many contexts: their windows are counted by their bytes. Also the
    written tables that the result reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, x, n, size, data in zip(*(batch.column(c).to_pylist() for c in ("h", "x", "n", "size", "context")), strict=True):
                windows = [xxhash.xxh3_128_digest(data[k : k + LENGTH]) for k in range(size)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([h] * size, pa.int64()),
                        pa.array([x] * size, pa.int64()),
                        pa.array([n] * size, pa.int64()),
                        pa.array(range(size), pa.int32()),
                        pa.array(windows, pa.binary()),
                    ],
                    names=["h", "x", "n", "low", "window"],
                )

    many = contexts.where("hot").select("h", "x", "n", "size", "context")
    windows = many.mapInArrow(run, "h long, x long, n long, low int, window binary")
    windows = keep(windows, "windows")
    often = keep(windows.groupBy("window").agg(F.sum("n").alias("_n")).where("_n > 1").select("window"), "often")
    found = windows.join(often, "window").select("h", "x", "low", (F.col("low") + LENGTH).alias("high"))
    return found, [windows, often]


def _spans(docs: DataFrame) -> DataFrame:
    """(_key, spans): of each text the byte ranges, perhaps overlapping, to remove."""
    runs = keep(_anchored(docs), "runs")
    twice = F.when(F.col("place") < 0, 2).otherwise(1)
    shared = runs.groupBy("h").agg(F.sum(twice).alias("_n")).where("_n > 1").select("h")
    members = keep(
        runs.join(shared, "h").groupBy("h", "x", "key", "start", "size", "place").agg(F.count(F.lit(1)).alias("n")),
        "members",
    )
    discard(runs)
    classes = members.groupBy("h", "x", "size", "place").agg(
        F.sum("n").alias("n"), F.min(F.struct("key", "start")).alias("one")
    )
    classes = keep(classes, "classes")
    anchors_ = keep(
        classes.groupBy("h").agg(
            F.count(F.lit(1)).alias("_classes"), F.max((F.col("place") < 0).cast("int")).alias("_self")
        ),
        "anchors",
    )
    # A run that all its copies share whole needs no sorting.
    sorted_ = classes.join(anchors_.where("_classes > 1 OR _self = 1"), "h").select(
        "h", "x", "size", "place", "n", "one", (F.col("_classes") > HOT).alias("hot")
    )
    wanted = sorted_.groupBy(F.col("one.key").alias("_key")).agg(
        F.collect_list(F.struct("h", "x", "n", "place", "hot", "size", F.col("one.start").alias("start"))).alias("runs")
    )
    first = docs.groupBy(F.col("key").alias("_first")).agg(F.min("doc_id").alias("_doc"))
    wanted = wanted.join(first, F.col("_key") == F.col("_first")).select("_key", "_doc", "runs")
    wanted = keep(wanted, "wanted")
    contexts = _contexts(docs, wanted)
    discard(anchors_, wanted)
    counted, read = _counted(contexts)
    found = keep(_sorted(contexts).unionByName(counted), "found")
    discard(contexts, *read)
    copied = classes.where("n > 1").select("h", "x")
    whole = members.join(copied, ["h", "x"]).select(
        "key", F.col("start").alias("low"), (F.col("start") + F.col("size") + LENGTH - 1).alias("high")
    )
    parts = members.join(found, ["h", "x"]).select(
        "key", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high")
    )
    spans = whole.unionByName(parts).groupBy(F.col("key").alias("_key"))
    out = keep(spans.agg(F.collect_set(F.struct("low", "high")).alias("spans")), "spans")
    discard(members, classes, found)
    return out


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    characters: bool = False,
    carry: Column | None = None,
) -> DataFrame:
    """Removes each byte covered by a string of 200 bytes that also starts anywhere else.

    Windows of 200 bytes are looked up by the smallest hash of the anchors they hold, so that
    equal windows meet; runs of windows whose anchor occurs once in the whole table are left.
    Runs whose contexts are equal are one class. The other contexts of an anchor, cut to what
    they share with any other, are sorted by suffix array in blocks; windows whose suffixes are
    neighbours and agree for 200 bytes are repeated. Anchors with more than 4,096 different
    contexts would fill one task; their windows are counted by 128-bit hashes instead, spread
    over all tasks. Strings are judged on the input and may overlap, in one document too.

    Returns doc_id, n_bytes, kept (binary, the remaining bytes; not always whole characters),
    n_removed, n_spans (maximal removed runs), with ``characters`` also text: the characters that
    remain whole, without the pieces at the ends of removed runs, and ``carry``, a column of any kind
    that comes along with each row. Null texts count as empty; rows of one doc_id
    are texts each, repeated rows repeat each other's strings; an empty table gives no rows;
    other columns are ignored.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        *([] if carry is None else [carry.alias("carry")]),
    ).withColumn("key", F.unhex(F.md5(F.col("text").cast("binary"))))
    carried = ["carry"] if carry is not None else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, kept, removed, count, whole = [], [], [], [], []
            for own, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                data, at, parts, n = own.as_py().encode(), 0, [], 0
                for low, high in merged([(s["low"], s["high"]) for s in spans.as_py() or []]):
                    parts.append(data[at:low])
                    at, n = high, n + 1
                parts.append(data[at:])
                sizes.append(len(data))
                kept.append(b"".join(parts))
                removed.append(len(data) - len(kept[-1]))
                count.append(n)
                if characters:  # each part by itself: pieces of two characters could make up a third
                    whole.append("".join([p.decode("utf-8", "ignore") for p in parts]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(kept, pa.binary()),
                    pa.array(removed, pa.int64()),
                    pa.array(count, pa.int64()),
                    *([pa.array(whole, pa.string())] if characters else []),
                    *(batch.column(c) for c in carried),
                ],
                names=[f.name for f in schema],
            )

    spans = _spans(rows.drop(*carried))
    joined = rows.join(spans, F.col("key") == F.col("_key"), "left").select("doc_id", "text", "spans", *carried)
    schema = T.StructType([joined.schema["doc_id"]])
    schema.add("n_bytes", T.LongType()).add("kept", T.BinaryType())
    schema.add("n_removed", T.LongType()).add("n_spans", T.LongType())
    if characters:
        schema.add("text", T.StringType())
    for c in carried:
        schema.add(joined.schema[c])
    return joined.mapInArrow(run, schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and adjoining ranges as one, ascending."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the remaining bytes."""
    return remove_repeats(docs, doc_id, text).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
