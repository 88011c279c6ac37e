"""Repeated passages, removed by suffix sorting in blocks with a difference cover.

A suffix needs sorting only as deep as a passage is long, and only against suffixes that may be equal
that far. So each window of LENGTH bytes is named by the smallest hash of the short strings in it;
equal windows have equal names, and neighbours mostly share one. A name and the run of windows
that has it are a suffix bucket's entry:

1. every text becomes a unit with its runs: name, digest of the run's bytes, place;
2. runs meet by name: a run whose digest occurs elsewhere is repeated as a whole, one
   whose name occurs nowhere else is not; what is left are buckets of runs that differ;
3. one block of such buckets after another is suffix-sorted: by the first bytes, then long ties by
   the ranks of a difference cover's sample, so that no comparison reads a whole passage and
   memory is that of one block;
4. the windows found repeated go back to their units, whose covered bytes are cut out.

A bucket with more runs than a task should hold is settled by hashes of its single windows in a
distributed count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import frequent, lean, saved, ship, slices
from strataflow.llm.features import BASE, mixed, powers, prefix_sums, span_hash
from strataflow.llm.tokens import spread

LENGTH = 200
#: Bytes whose hash can name a window.
NAME = 32
#: Runs in one bucket that a task sorts.
BUCKET = 65_536
#: Windows that are sorted at a time.
BLOCK = 400_000
#: Counters of the sketch that finds busy names.
TRACKED = 65_536
SLICE = 1 << 20
PART = 4 << 20
#: A perfect difference set: every number modulo PERIOD is a difference of two of its members.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: _SHIFT[a, b]: the least shift that takes positions a and b (modulo PERIOD) both into the cover.
_SHIFT = np.array(
    [
        [next(s for s in range(PERIOD) if _IN_COVER[(a + s) % PERIOD] and _IN_COVER[(b + s) % PERIOD])
         for b in range(PERIOD)]
        for a in range(PERIOD)
    ]
)
_INVERSE = pow(BASE, -1, 1 << 64)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    count = len(values) - width + 1
    rows = -(-len(values) // width)
    grid = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    grid[: len(values)] = values
    grid = grid.reshape(rows, width)
    after = np.minimum.accumulate(grid, axis=1).ravel()
    before = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(before[:count], after[width - 1 : width - 1 + count])


def named_runs(data: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Runs of windows that share a name: text, first and last start in it, name, digest, lead.

    The lead is the distance from a run's first window to the string that gives the name.
    """
    ends = np.repeat(offsets[1:], np.diff(offsets))
    valid = np.flatnonzero(np.arange(len(data)) + length <= ends)
    if not len(valid):
        none = np.zeros(0, np.int64)
        return {k: none for k in ("text", "lo", "hi", "lead")} | {
            k: none.astype(np.uint64) for k in ("name", "digest")
        }
    sums = prefix_sums(data)
    count = len(data) - NAME + 1
    hashes = mixed((sums[NAME:] - sums[:-NAME]) * powers(_INVERSE, count))
    # The leftmost of equal ones: places in the low bits.
    low = np.uint64((1 << count.bit_length()) - 1)
    places = np.arange(count, dtype=np.uint64)
    least = sliding_least(hashes & ~low | places, length - NAME + 1)
    place = (least[valid] & low).astype(np.int64)
    text = np.searchsorted(offsets, valid, "right") - 1
    first = np.r_[True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])]
    begin = np.flatnonzero(first)
    last = valid[np.r_[begin[1:], len(valid)] - 1]
    begin, place, text = valid[begin], place[begin], text[begin]
    return {
        "text": text,
        "lo": begin - offsets[text],
        "hi": last - offsets[text],
        "lead": place - begin,
        "name": hashes[place],
        "digest": span_hash(sums, begin, last + length) + (last - begin).astype(np.uint64),
    }


def runs_of(texts: list[bytes], length: int) -> dict[str, np.ndarray]:
    """The runs of all texts; a very long one is taken in parts that overlap by a window."""
    found, short = [], []
    for k, text in enumerate(texts):
        if len(text) <= PART:
            short.append(k)
            continue
        for base in range(0, len(text) - length + 1, PART):
            part = np.frombuffer(text, np.uint8)[base : base + PART + length - 1]
            runs = named_runs(part, np.array([0, len(part)]), length)
            found.append(runs | {"text": runs["text"] + k} | {
                edge: runs[edge] + base for edge in ("lo", "hi")
            })
    data = np.frombuffer(b"".join(texts[k] for k in short), np.uint8)
    offsets = np.cumsum([0, *[len(texts[k]) for k in short]])
    runs = named_runs(data, offsets, length)
    if len(runs["text"]):
        runs["text"] = np.array(short)[runs["text"]]
    found.append(runs)
    together = {k: np.concatenate([r[k] for r in found]) for k in runs}
    order = np.lexsort((together["lo"], together["text"]))
    return {k: v[order] for k, v in together.items()}


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted, disjoint runs that hold the same numbers (both ends included)."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order]) if len(lo) else hi
    first = np.ones(len(lo), bool)
    first[1:] = lo[1:] > hi[:-1] + 1
    begin = np.flatnonzero(first)
    return lo[begin], hi[np.r_[begin[1:], len(lo)][: len(begin)] - 1] if len(lo) else hi


def units(docs: DataFrame, length: int, row: str) -> DataFrame:
    """A row for each text: the column row, unit, first, n, its bytes (z) and its runs as lists.

    ``first`` is the unit of the first equal text of the task; only that one has bytes and runs.
    Runs that are equal within the unit are given once; all their places are in known_lo, known_hi.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        squeeze = zstandard.ZstdCompressor(level=3)
        for part in slices(batches, "text", SLICE):
            ids = part.column("unit").to_pylist()
            raw = [t.as_buffer().to_pybytes() for t in part.column("text")]
            first = [seen.setdefault(hashlib.md5(t).digest(), u) for t, u in zip(raw, ids)]
            own = [k for k, (u, f) in enumerate(zip(ids, first)) if u == f]
            runs = runs_of([raw[k] for k in own], length)
            name, digest, text = runs["name"], runs["digest"], runs["text"]
            same = mixed(mixed(name + text.astype(np.uint64)) ^ digest)
            _, at, group, many = np.unique(
                same, return_index=True, return_inverse=True, return_counts=True
            )
            known = np.flatnonzero(many[group] > 1)
            order = np.argsort(at)
            keep = at[order]
            where = np.full(part.num_rows + 1, 0, np.int64)

            def lists(column: np.ndarray, owner: np.ndarray, kind: pa.DataType) -> pa.Array:
                where[:] = 0
                np.add.at(where, np.array(own, np.int64)[owner] + 1, 1)
                return pa.ListArray.from_arrays(
                    pa.array(np.cumsum(where), pa.int32()), pa.array(column, kind)
                )

            signed = {k: runs[k].view(np.int64) for k in ("name", "digest")}
            columns = {
                "row": part.column("row"),
                "unit": part.column("unit"),
                "first": pa.array(first, pa.int64()),
                "n": pa.array(map(len, raw), pa.int64()),
                "z": pa.array(
                    [squeeze.compress(t) if u == f else None for t, u, f in zip(raw, ids, first)],
                    pa.binary(),
                ),
                **{k: lists(signed[k][keep], text[keep], pa.int64()) for k in signed},
                **{k: lists(runs[k][keep], text[keep], pa.int32()) for k in ("lo", "hi", "lead")},
                "multi": lists(many[order] > 1, text[keep], pa.bool_()),
                **{
                    f"known_{k}": lists(runs[k][known], text[known], pa.int32()) for k in ("lo", "hi")
                },
            }
            yield pa.record_batch(list(columns.values()), list(columns))

    numbered = docs.withColumn("unit", F.monotonically_increasing_id())
    return numbered.mapInArrow(
        lean(run),
        f"row {row}, unit long, first long, n long, z binary, name array<long>, "
        "digest array<long>, lo array<int>, hi array<int>, lead array<int>, multi array<boolean>, "
        "known_lo array<int>, known_hi array<int>",
    )


#: What becomes of a run: repeated as a whole; sorted, and it wants to know; sorted for the others;
#: in a bucket that is too large.
WHOLE, ASKS, HELPS, BUSY = range(4)


def meet(runs: DataFrame, bucket: int) -> DataFrame:
    """(unit, lo, hi, lead, name, digest, fate) of the runs that have a fate."""
    columns = ["name", "digest", "unit", "lo", "hi", "lead", "multi"]

    def settle(own: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        name, digest = own["name"], own["digest"]
        new = np.r_[True, (name[1:] != name[:-1])]
        other = np.r_[True, new[1:] | (digest[1:] != digest[:-1])]
        bucket_of, digest_of = np.cumsum(new) - 1, np.cumsum(other) - 1
        many = np.bincount(digest_of) > 1
        np.logical_or.at(many, digest_of, own["multi"])
        whole = many[digest_of]
        mixed_bucket = np.bincount(bucket_of[other])[bucket_of] > 1
        asks, helps = mixed_bucket & ~whole, mixed_bucket & whole & other
        parts = [(whole, WHOLE), (asks, ASKS), (helps, HELPS)]
        rows = {k: np.concatenate([own[k][m] for m, _ in parts]) for k in columns[:-1]}
        return rows | {"fate": np.concatenate([np.full(int(m.sum()), f) for m, f in parts])}

    def out(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.int32()] * 4
        return pa.record_batch(
            [pa.array(v).cast(t) for v, t in zip(rows.values(), kinds)], list(rows)
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[str, np.ndarray] = {}
        busy = None
        for batch in batches:
            if not batch.num_rows:
                continue
            more = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in columns}
            own = {k: np.concatenate([own[k], more[k]]) if own else more[k] for k in columns}
            names = own["name"]
            # The last bucket may go on in the next batch.
            cut = int(np.searchsorted(names, names[-1]))
            if busy is not None:
                gone = int(np.searchsorted(names, busy, "right"))
                if gone:
                    yield out(flagged({k: own[k][:gone] for k in columns}))
                own = {k: v[gone:] for k, v in own.items()}
                cut -= gone
                if cut < 0:
                    continue
            if cut:
                yield out(settle({k: v[:cut] for k, v in own.items()}))
                own = {k: v[cut:] for k, v in own.items()}
            busy = None
            if len(own["name"]) > bucket:
                busy = own["name"][0]
                yield out(flagged(own))
                own = {k: v[:0] for k, v in own.items()}
        if own and len(own["name"]):
            yield out(settle(own))

    def flagged(own: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        # A run that is known to be repeated in its unit is given twice, as it counts as two.
        rows = {k: np.concatenate([own[k], own[k][own["multi"]]]) for k in columns[:-1]}
        return rows | {"fate": np.full(len(rows["name"]), BUSY)}

    sorted_runs = runs.select(columns).repartition("name")
    return sorted_runs.sortWithinPartitions("name", "digest").mapInArrow(
        lean(run), "name long, digest long, unit long, lo int, hi int, lead int, fate int"
    )


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes at every position as a number that sorts as they do."""
    padded = np.zeros(len(data) + 64, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 56,), np.dtype(">u8"), padded, 0, (1,))


_KEEP = np.array([(1 << 64) - (1 << 8 * (8 - n)) for n in range(9)], np.uint64)


def word(words: np.ndarray, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    """The first ``n`` (0 to 8, clipped) of the eight bytes at each position."""
    return words[at].astype(np.uint64) & _KEEP[np.clip(n, 0, 8)]


def cover_ranks(data: np.ndarray, words: np.ndarray, periods: int) -> np.ndarray:
    """At every position of the cover: the rank of the ``periods`` * PERIOD bytes there.

    Ranks of one period are sorted from the bytes, longer ones from pairs of shorter ranks a whole
    number of periods apart, which are positions of the cover again.
    """
    size = len(data)
    at = np.flatnonzero(_IN_COVER[np.arange(size) % PERIOD])

    def ranked(key: np.ndarray) -> np.ndarray:
        out = np.zeros(size + PERIOD * (periods + 1), np.int64)
        out[at] = np.unique(key, return_inverse=True)[1]
        return out

    one = ranked(word(words, at, 8))
    for skip in range(8, PERIOD, 8):
        next_word = np.unique(word(words, at + skip, PERIOD - skip), return_inverse=True)[1]
        one = ranked(one[at] * (size + 1) + next_word)

    def joined(a: np.ndarray, b: np.ndarray, apart: int) -> np.ndarray:
        return ranked(a[at] * (size + 1) + b[at + apart * PERIOD])

    whole, done = None, 0
    power, covered = one, 1
    while True:
        if periods & covered:
            whole, done = (power, covered) if whole is None else (
                joined(whole, power, done), done + covered
            )
        if covered * 2 > periods:
            return whole
        power, covered = joined(power, power, covered), covered * 2


def repeated_windows(
    data: np.ndarray, at: np.ndarray, group: np.ndarray, length: int, ranks: np.ndarray | None = None
) -> np.ndarray:
    """Which windows (start ``at``) equal another of their ``group`` over ``length`` bytes."""
    words = words_at(data)
    periods = (length - PERIOD + 1) // PERIOD
    if ranks is None:
        ranks = cover_ranks(data, words, periods)
    depth = periods * PERIOD
    found = np.zeros(len(at), bool)
    left = np.arange(len(at))

    def split(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Sorted by group and keys: the windows that are not alone, and their new group."""
        order = np.lexsort((*keys[::-1], group[left]))
        own = left[order]
        new = np.r_[True, group[own[1:]] != group[own[:-1]]] if len(own) else np.zeros(0, bool)
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        number = np.cumsum(new) - 1
        many = np.bincount(number)[number] > 1 if len(own) else new
        return own[many], number[many]

    group = group.copy()
    # By the bytes before the farthest cover position ...
    for skip in range(0, PERIOD - 1, 8):
        kept, number = split([word(words, at[left] + skip, PERIOD - 1 - skip)])
        left = kept
        group[left] = number
    # ... then ties against one of each group, by ranks of the cover and the few bytes behind.
    while len(left):
        order = left[np.argsort(group[left], kind="stable")]
        first = np.r_[True, group[order[1:]] != group[order[:-1]]]
        pivot = order[first][np.cumsum(first) - 1]
        left = order
        shift = _SHIFT[at[left] % PERIOD, at[pivot] % PERIOD]
        a, b = ranks[at[left] + shift], ranks[at[pivot] + shift]
        side = np.sign(a - b)
        rest = length - depth - shift
        for skip in range(0, length - depth, 8):
            tie = np.flatnonzero((side == 0) & (rest > skip))
            if not len(tie):
                break
            behind = shift[tie] + depth + skip
            x = word(words, at[left[tie]] + behind, rest[tie] - skip)
            y = word(words, at[pivot[tie]] + behind, rest[tie] - skip)
            side[tie] = (x > y).astype(np.int64) - (x < y)
        equal = side == 0
        number = np.cumsum(first) - 1
        many = np.bincount(number, equal)[number] > 1
        found[left[equal & many]] = True
        left, side, number = left[~equal], side[~equal], number[~equal]
        group[left] = number * 2 + (side > 0)
        size = np.bincount(group[left], minlength=1)
        left = left[size[group[left]] > 1]
    return found


def sort_blocks(segments: DataFrame, length: int, block: int) -> DataFrame:
    """(unit, lo, hi) of repeated windows from segments of the bytes of runs, bucket by bucket."""

    def settle(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        data = np.frombuffer(b"".join(r[-1] for r in rows), np.uint8)
        bucket = np.unique(np.array([r[0] for r in rows]), return_inverse=True)[1]
        unit, lo, hi, lead, fate = (np.array([r[k] for r in rows], np.int64) for k in range(2, 7))
        count = hi - lo + 1
        size = count + length - 1
        start = np.cumsum(size) - size
        words = words_at(data)
        ranks = cover_ranks(data, words, (length - PERIOD + 1) // PERIOD)
        # Windows are equal only at the same distance to the string that gives the name.
        step = max(1, block // len(rows))
        units, los, his = [], [], []
        for least in range(0, length, step):
            # Windows at distances least ... least + step - 1, as ranges in each run.
            begin = np.clip(lead - (least + step - 1), 0, count)
            end = np.clip(lead - least + 1, 0, count)
            own = np.maximum(end - begin, 0)
            if not own.any():
                continue
            run = np.repeat(np.arange(len(rows)), own)
            offset = spread(begin, own)
            group = bucket[run] * (length + 1) + lead[run] - offset
            flags = repeated_windows(data, start[run] + offset, group, length, ranks)
            flags &= fate[run] == ASKS
            units.append(unit[run[flags]])
            los.append((lo[run] + offset)[flags])
        if not units:
            return
        unit, lo = np.concatenate(units), np.concatenate(los)
        order = np.lexsort((lo, unit))
        unit, lo = unit[order], lo[order]
        first = np.ones(len(lo), bool)
        first[1:] = (unit[1:] != unit[:-1]) | (lo[1:] > lo[:-1] + 1)
        begin = np.flatnonzero(first)
        his = lo[np.r_[begin[1:], len(lo)] - 1] if len(lo) else lo
        yield pa.record_batch(
            [pa.array(unit[begin]), pa.array(lo[begin], pa.int32()), pa.array(his[: len(begin)], pa.int32())],
            ["unit", "lo", "hi"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        windows = 0
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            for row in zip(*columns):
                if windows > block and row[0] != waiting[-1][0]:
                    yield from settle(waiting)
                    waiting, windows = [], 0
                waiting.append(row)
                windows += row[4] - row[3] + 1
        if waiting:
            yield from settle(waiting)

    sorted_rows = segments.repartition("name").sortWithinPartitions("name", "digest")
    return sorted_rows.mapInArrow(lean(run), "unit long, lo int, hi int")


def with_bytes(table: DataFrame, lists: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over (unit, bytes, items) of the units that have items."""
    items = lists.groupBy("unit").agg(F.collect_list("item").alias("items"))

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            for unit, z, own in zip(*(batch.column(k).to_pylist() for k in range(3))):
                yield from run(unit, expand.decompress(z) if z else b"", own)

    bytes_of = table.where("unit = first").select("unit", "z")
    return bytes_of.join(items, "unit").select("unit", "z", "items").mapInArrow(lean(unpacked), schema)


def segments_of(table: DataFrame, met: DataFrame, length: int) -> DataFrame:
    """The bytes of the runs that are to be sorted, in the columns that sort_blocks takes."""
    names = ["name", "digest", "lo", "hi", "lead", "fate"]

    def run(unit: int, text: bytes, items: list[dict]) -> Iterator[pa.RecordBatch]:
        own = {k: [x[k] for x in items] for k in names}
        data = [text[a : b + length] for a, b in zip(own["lo"], own["hi"])]
        kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
        columns = [pa.array(own[k], t) for k, t in zip(names, kinds)]
        columns.insert(2, pa.array([unit] * len(items), pa.int64()))
        yield pa.record_batch([*columns, pa.array(data, pa.binary())], [*names[:2], "unit", *names[2:], "data"])

    wanted = met.where(F.col("fate").isin(ASKS, HELPS)).select("unit", F.struct(*names).alias("item"))
    schema = (
        "name long, digest long, unit long, lo int, hi int, lead int, fate int, data binary"
    )
    return with_bytes(table, wanted, run, schema)


def busy_windows(table: DataFrame, busy: DataFrame, length: int) -> DataFrame:
    """(unit, lo, hi) of repeated windows in the runs of busy names, by a distributed count."""
    by = ["name", "digest"]
    place = F.struct("unit", "lo", "hi")
    groups = busy.groupBy(by).agg(F.count("*").alias("n"), F.min(place).alias("one"))
    whole = busy.join(groups.where("n > 1").select(by), by).select("unit", "lo", "hi").distinct()
    wanted = groups.select(
        "one.unit", F.struct("one.lo", "one.hi", (F.col("n") == 1).alias("asks")).alias("item")
    )

    def run(unit: int, text: bytes, items: list[dict]) -> Iterator[pa.RecordBatch]:
        data = np.frombuffer(text, np.uint8)
        lo, hi = (np.array([x[k] for x in items], np.int64) for k in ("lo", "hi"))
        at = spread(lo, hi - lo + 1)
        asks = np.repeat([x["asks"] for x in items], hi - lo + 1)
        # Two hashes, the second over the bytes in another order.
        names = [
            span_hash(prefix_sums(x), at, at + length).view(np.int64)
            for x in (data, (data * np.uint8(167)) ^ np.uint8(0x5A))
        ]
        columns = [*names, np.full(len(at), unit), at]
        yield pa.record_batch(
            [*map(pa.array, columns), pa.array(asks)], ["f1", "f2", "unit", "lo", "asks"]
        )

    windows = saved(
        with_bytes(table, wanted, run, "f1 long, f2 long, unit long, lo long, asks boolean"),
        "busy-windows",
    )
    several = windows.groupBy("f1", "f2").agg(F.count("*").alias("n")).where("n > 1")
    found = windows.where("asks").join(several, ["f1", "f2"], "left_semi")
    lo = F.col("lo").cast("int")
    return whole.unionAll(found.select("unit", lo.alias("lo"), lo.alias("hi")))


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    text_column: str = "text",
    keep: list[str] | None = None,
    with_text: bool = False,
    bucket: int = BUCKET,
    block: int = BLOCK,
    tracked: int = TRACKED,
) -> DataFrame:
    """One row per row of ``docs``: the columns ``keep`` (default: doc_id), then n_bytes, n_removed,
    n_spans, kept_sha256, and with ``with_text`` the remaining text as ``kept``, without the characters
    of which only a part remains.

    Texts are their UTF-8 bytes; each byte covered by a string of ``length`` bytes that starts anywhere
    else too, in the same text or another, is removed; strings are judged on the input. NULL counts
    as empty, and texts shorter than ``length`` stay. Repeated rows are texts of their own, so that
    they remove each other. Ids are not looked at. An empty table gives no rows.
    """
    if length < 2 * PERIOD + NAME:
        raise ValueError(f"length must be at least {2 * PERIOD + NAME}")
    ship(docs.sparkSession)
    carried = F.struct(*[F.col(c) for c in (["doc_id"] if keep is None else keep)])
    plain = docs.select(carried.alias("row"), F.coalesce(text_column, F.lit("")).alias("text"))
    table = saved(units(plain, length, plain.schema["row"].dataType.simpleString()), "units")
    owners = table.where("unit = first")
    columns = ["name", "digest", "lo", "hi", "lead", "multi"]
    zipped = F.explode(F.arrays_zip(*columns)).alias("run")
    runs = owners.select("unit", zipped).select("unit", *[f"run.{c}" for c in columns])

    # Names with too many runs for one task go another way; the sketch names most of them beforehand.
    hot = saved(frequent(runs, "name", tracked, 4_096, bucket), "busy-names")
    large = {"spark.sql.execution.arrow.maxRecordsPerBatch": "65536"}
    met = saved(meet(runs.join(F.broadcast(hot), "name", "left_anti"), bucket), "met-runs", large)
    known = runs.join(F.broadcast(hot), "name", "left_semi")
    twice = F.explode(F.array_repeat(F.lit(0), F.when(F.col("multi"), 2).otherwise(1)))
    busy = known.select("unit", "lo", "hi", "name", "digest", twice.alias("copy")).drop("copy")
    busy = busy.unionAll(met.where(F.col("fate") == BUSY).select("unit", "lo", "hi", "name", "digest"))

    found = met.where(F.col("fate") == WHOLE).select("unit", "lo", "hi")
    sorted_windows = sort_blocks(segments_of(table, met, length), length, block)
    found = found.unionAll(saved(sorted_windows, "sorted-windows"))
    if busy.take(1):
        found = found.unionAll(busy_windows(table, busy, length))
    # All of a text that a task met more than once.
    copies = table.groupBy(F.col("first").alias("unit")).agg(
        F.count("*").alias("copies"), F.max("n").alias("n")
    )
    copies = copies.where((F.col("copies") > 1) & (F.col("n") >= length)).select(
        "unit", F.lit(0).alias("lo"), (F.col("n") - length).cast("int").alias("hi")
    )
    ranges = found.unionAll(copies).groupBy("unit").agg(
        F.collect_list("lo").alias("los"), F.collect_list("hi").alias("his")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            rows: list[tuple] = []
            for row in zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns))):
                unit, z, known_lo, known_hi, los, his = row
                text = expand.decompress(z) if z else b""
                lo = np.array([*known_lo, *(los or [])], np.int64)
                lo, hi = merged(lo, np.array([*known_hi, *(his or [])], np.int64) + length - 1)
                edges = [0, *np.stack([lo, hi + 1], axis=1).ravel().tolist(), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                digest = hashlib.sha256(kept).hexdigest()
                left = kept.decode("utf-8", "ignore") if with_text else None
                rows.append((unit, len(text) - len(kept), len(lo), digest, left))
            fields = list(zip(*rows))[: 5 if with_text else 4]
            if rows:
                yield pa.record_batch([pa.array(x) for x in fields], names)

    names = ["unit", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 if with_text else 4]
    result = owners.join(ranges, "unit", "left").select(
        "unit", "z", "known_lo", "known_hi", "los", "his"
    )
    schema = "unit long, n_removed long, n_spans long, kept_sha256 string"
    done = saved(result.mapInArrow(lean(cut), schema + ", kept string" * with_text), "kept")
    rows = table.select("row", F.col("first").alias("unit"), F.col("n").alias("n_bytes"))
    return rows.join(done, "unit").select("row.*", "n_bytes", *names[1:])


def without_repeats(docs: DataFrame, text_column: str = "text", **parameters: int) -> DataFrame:
    """All rows of ``docs`` with repeated passages cut out of the text; n_chars, if there, follows.

    A NULL text stays NULL, and its row as it is.
    """
    names = docs.columns
    others = [F.col(c) for c in names if c != text_column]
    carried = docs.select(
        F.struct(F.col(text_column).isNull().alias("__null"), *others).alias("__row"),
        F.col(text_column).alias("__text"),
    )
    cut = remove_repeats(carried, text_column="__text", keep=["__row"], with_text=True, **parameters)
    row, there = F.col("__row"), ~F.col("__row")["__null"]

    def column(name: str) -> Column:
        if name == text_column:
            return F.when(there, F.col("kept"))
        if name == "n_chars":
            count = F.length("kept").cast(docs.schema[name].dataType)
            return F.when(there, count).otherwise(row[name])
        return row[name]

    return cut.select(*[column(c).alias(c) for c in names])
