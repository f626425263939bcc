"""Removal of every byte that a repeated long string covers, by suffix sorting.

Two equal strings of 400 bytes hold the same 128-byte grams, and so have the same gram of smallest hash at the same
place: their anchor. Neighbouring strings of a text mostly have one anchor in common; their stretch of text is a
region. So equal strings lie in regions of equal anchors, and a group of regions with one anchor is a piece of work of
its own.

1. Tasks list the regions of all texts by the hashes of anchor and content. Only groups with more than one region stay.
2. A group of equal regions (copies) needs no sorting: all its strings are repeated. Regions are counted and combined
   before their text is fetched, so a passage that a third of all documents hold is sorted once.
3. The regions of the other groups are dealt out by anchor and joined to shards. A task orders the suffixes of a shard
   by external induced sorting (see `induced`); strings whose suffix has 400 bytes in common with a neighbour repeat.
4. A group of more text than a shard is dealt further first. Equal strings also have the same distance to the anchor;
   those of 17 neighbouring distances have 384 bytes in common, whose hash and distances name a smaller group. Pieces of
   regions are grouped, counted and sorted like regions; groups that are still too large go on by single distances,
   where a group holds equal strings only.
5. The covered bytes go back to all documents that hold the region.

Texts move through one shuffle, combined by content first. Texts are known by two 64-bit hashes.

Defined cases: a missing text is an empty one; texts of less than 400 bytes lose nothing; repeated rows are copies of
each other, ids do not matter; other columns pass through `without_repeats`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeropanel.llm import induced, texts
from aeropanel.session import scratch_path

LENGTH = 400
GRAM = 128
SHARD_BYTES = 2 << 20
#: Parts into which the distances of strings to an anchor are cut, when its group is dealt further.
DISTANCE_PARTS = 17
KEY = ["k1", "k2"]


def _byte_slices(values: list[bytes], most: int = texts.SLICE_CHARS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bytes, bounds) of neighbouring texts; a text is never cut."""
    first, size = 0, 0
    for i, value in enumerate([*values, None]):
        if i == len(values) or size and size + len(value) > most:
            if i > first:
                bounds = np.zeros(i - first + 1, np.int64)
                np.cumsum([len(v) for v in values[first:i]], out=bounds[1:])
                yield first, np.frombuffer(b"".join(values[first:i]), np.uint8), bounds
            first, size = i, 0
        size += len(value or b"")


def _sliding_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every window, from minima towards both ends of blocks of that width."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def regions(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchor hash, content hash, text, first string and number of strings of every region of a slice of texts."""
    n = len(data)
    nothing = tuple(np.zeros(0, np.int64) for _ in range(5))
    if n < length:
        return nothing
    total, inverse = texts.running_hashes(data)
    grams = texts.mixed((total[gram:] - total[:-gram]) * inverse[:len(total) - gram])
    # 32 bits of hash above the place: the first of equal ones is the smallest
    keys = (grams >> np.uint64(32)) << np.uint64(32) | np.arange(len(grams), dtype=np.uint64)
    anchor = _sliding_minima(keys, length - gram + 1) & np.uint64(0xFFFFFFFF)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:len(anchor)]
    starts = np.flatnonzero(np.arange(len(anchor)) + length <= bounds[owner + 1])
    if not len(starts):
        return nothing
    at = anchor[starts]
    new = np.append(True, at[1:] != at[:-1])
    first = starts[new]
    count = np.diff(np.flatnonzero(new), append=len(starts))
    end = first + count - 1 + length
    content = texts.mixed((total[end] - total[first]) * inverse[first] + (end - first).astype(np.uint64))
    text = owner[first]
    return grams[at[new].astype(np.int64)].view(np.int64), content.view(np.int64), text, first - bounds[text], count


def _listed(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [t.encode("utf-8", "surrogatepass") for t in texts.column_texts(batch.column("text"))]
            k1, k2 = (batch.column(k).to_numpy() for k in KEY)
            for at, data, bounds in _byte_slices(values):
                anchor, content, text, first, count = regions(data, bounds, length, gram)
                yield pa.record_batch([pa.array(a) for a in (k1[text + at], k2[text + at], anchor, content, first, count)],
                                      names=[*KEY, "anchor", "content", "first", "strings"])
    return run


def _cut_out(length: int, large: bool):
    """Texts with the regions wanted of them -> one row per region with its bytes, of large groups or of the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, told in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
                wanted = [w for w in told if w["large"] == large]
                if wanted:
                    data = text.encode("utf-8", "surrogatepass")
                    cut = [data[w["first"]:w["first"] + w["strings"] - 1 + length] for w in wanted]
                    yield pa.record_batch([pa.array([w["anchor"] for w in wanted]), pa.array([w["content"] for w in wanted]),
                                           pa.array([w["copies"] for w in wanted]), pa.array([-1] * len(wanted)),
                                           pa.array(cut, pa.binary())], names=["anchor", "content", "copies", "place", "data"])
    return run


def pieces(data: np.ndarray, bounds: np.ndarray, place: np.ndarray, width: int, length: int = LENGTH,
           gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Group hash, content hash, region, first string, number of strings and place of the anchor of every piece.

    A piece holds the strings of a region (or piece) at `width` neighbouring distances to its anchor. A place of -1 is
    looked for: the gram of smallest hash, the first of equal ones.
    """
    total, inverse = texts.running_hashes(data)
    grams = texts.mixed((total[gram:] - total[:-gram]) * inverse[:len(total) - gram])
    keys = (grams >> np.uint64(32)) << np.uint64(32) | np.arange(len(grams), dtype=np.uint64)
    inside = np.ravel(np.column_stack([bounds[:-1], bounds[1:] - gram + 1]))
    smallest = np.minimum.reduceat(np.append(keys, np.uint64(0)), inside)[::2] & np.uint64(0xFFFFFFFF)
    place = np.where(place < 0, smallest.astype(np.int64) - bounds[:-1], place)

    strings = np.diff(bounds) - length + 1
    low, high = (place - strings + 1) // width, place // width
    count = high - low + 1
    region = np.repeat(np.arange(len(place)), count)
    part = np.arange(len(region)) - np.repeat(np.cumsum(count) - count, count) + low[region]
    at, own = bounds[region], place[region]
    latest, earliest = own - part * width, own - part * width - width + 1
    first = np.maximum(earliest, 0)
    held = np.minimum(latest, strings[region] - 1) - first + 1

    def hashes(begin: np.ndarray, end: np.ndarray, more: np.ndarray) -> np.ndarray:
        return texts.mixed((total[end] - total[begin]) * inverse[begin] + texts.mixed(more.astype(np.uint64)))

    # what all strings at these distances hold
    group = hashes(at + latest, at + earliest + length, part * (length + 1) + width)
    content = hashes(at + first, at + first + held - 1 + length, part * (length + 1) + held)
    return group.view(np.int64), content.view(np.int64), region, first, held, own - first


def _split(length: int, gram: int, width: int):
    """Regions or pieces with their bytes -> the smaller pieces of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy()
            for at, data, bounds in _byte_slices(batch.column("data").to_pylist()):
                group, content, region, first, strings, own = pieces(data, bounds, place[at:at + len(bounds) - 1], width, length, gram)
                rows = batch.select(["anchor", "content", "copies"]).take(pa.array(region + at))
                yield pa.record_batch([*rows.columns, *(pa.array(a) for a in (group, content, first, strings, own))],
                                      names=["_anchor", "_content", "copies", "anchor", "content", "first", "strings", "place"])
    return run


def _cut_pieces(length: int, large: bool):
    """Regions or pieces with the smaller pieces wanted of them -> one row per piece with its bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(w["anchor"], w["content"], w["copies"], w["place"], data[w["first"]:w["first"] + w["strings"] - 1 + length])
                     for data, wanted in zip(batch.column("data").to_pylist(), batch.column("wanted").to_pylist())
                     for w in wanted if w["large"] == large]
            if found:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found), kinds)],
                                      names=["anchor", "content", "copies", "place", "data"])
    return run


def covered(places: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Stretches that the strings of `length` at rising places cover."""
    if not len(places):
        return []
    new = np.append(True, np.diff(places) > length)
    last = np.append(places[np.flatnonzero(new)[1:] - 1], places[-1])
    return list(zip(places[new].tolist(), (last + length).tolist()))


def repeated_places(parts: list[bytes], length: int, memory: int = induced.MEMORY) -> list[np.ndarray]:
    """For each of the parts, the places of its strings of `length` that are elsewhere in the parts too."""
    bounds = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=bounds[1:])
    # 0 ends the whole, 1 each part, bytes are moved up by 2
    joined = np.frombuffer(b"\x00".join(parts) + b"\x00", np.uint8).astype(np.int32) + 2
    joined[bounds[1:] - 1] = 1
    joined = np.append(joined, 0).astype(np.int32)
    repeats = np.zeros(len(joined), bool)
    before = None
    for suffixes, prefixes in induced.descending(joined, length, memory):
        same = np.flatnonzero(prefixes >= length)
        repeats[suffixes[same]] = True
        repeats[suffixes[same[same > 0] - 1]] = True
        if len(same) and same[0] == 0 and before is not None:
            repeats[before] = True
        before = suffixes[-1]
    places = np.flatnonzero(repeats)
    owner = np.searchsorted(bounds, places, "right") - 1
    inside = owner < len(parts)
    # what two strings have in common may run across the end of a part
    inside[inside] = places[inside] + length < bounds[owner[inside] + 1]
    places, owner = places[inside], owner[inside]
    cuts = np.searchsorted(owner, np.arange(len(parts) + 1))
    return [places[a:b] - bounds[i] for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def _sorted_shards(length: int, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, int, bytes]] = []
        size = 0

        def shard() -> pa.RecordBatch:
            found = repeated_places([r[3] for r in rows], length)
            spans = [[(0, len(r[3]))] if r[2] > 1 else covered(places, length) for r, places in zip(rows, found)]
            kept = [(r[0], r[1], [{"begin": a, "end": b} for a, b in s]) for r, s in zip(rows, spans) if s]
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            return pa.record_batch([pa.array([k[0] for k in kept], pa.int64()), pa.array([k[1] for k in kept], pa.int64()),
                                    pa.array([k[2] for k in kept], kind)], names=["anchor", "content", "spans"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "content", "copies", "data"))):
                # a group of regions is never cut
                if size >= shard_bytes and row[0] != rows[-1][0]:
                    yield shard()
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
        if rows:
            yield shard()
    return run


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans."""
    found: list[tuple[int, int]] = []
    for span in sorted((s["begin"], s["end"]) for s in spans):
        if found and span[0] <= found[-1][1]:
            found[-1] = (found[-1][0], max(found[-1][1], span[1]))
        else:
            found.append(span)
    return found


def kept_bytes(text: str, spans: list[tuple[int, int]]) -> bytes:
    data = text.encode("utf-8", "surrogatepass")
    starts = [0, *(b for _, b in spans)]
    ends = [*(a for a, _ in spans), len(data)]
    return b"".join(data[a:b] for a, b in zip(starts, ends))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        merged = [_merged(s) for s in batch.column("spans").to_pylist()]
        kept = [hashlib.sha256(kept_bytes(t, s)).hexdigest() for t, s in zip(batch.column("text").to_pylist(), merged)]
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        removed = [sum(b - a for a, b in s) for s in merged]
        yield pa.record_batch(
            [*(batch.column(k) for k in KEY), pa.array(removed, pa.int64()), pa.array([len(s) for s in merged], pa.int64()),
             pa.array(kept, pa.string()), pa.array([[{"begin": a, "end": b} for a, b in s] for s in merged], kind)],
            names=[*KEY, "n_removed", "n_spans", "kept_sha256", "removed"])


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _keyed(documents: DataFrame, *columns: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(*columns, text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))


def _with_size(one: DataFrame, length: int, shard_bytes: int, path: str) -> tuple[DataFrame, bool]:
    """`one` (anchor, content, strings, ...) with `large`, whether its group is more than a shard; whether any is."""
    sizes = one.groupBy("anchor").agg(F.sum(F.col("strings") + (length - 1)).alias("size"))
    # at most one group per shard of text
    large = _written(sizes.filter(F.col("size") > shard_bytes).select(F.col("anchor").alias("_large")), path)
    marked = one.join(large, F.col("anchor") == F.col("_large"), "left").withColumn("large", F.col("_large").isNotNull()).drop("_large")
    return marked, not large.isEmpty()


def _repeated(listed: DataFrame, path: str) -> DataFrame:
    """The rows of groups with more than one member, and whether their contents `differ`."""
    n = F.sum("copies") if "copies" in listed.columns else F.count("*")
    groups = listed.groupBy("anchor").agg(n.alias("n"), F.min("content").alias("low"), F.max("content").alias("high"))
    groups = groups.filter(F.col("n") > 1).select(F.col("anchor").alias("_group"), (F.col("low") != F.col("high")).alias("differ"))
    # written, so that the join reads both sides by plain exchanges and a frequent anchor can be split
    return listed.join(_written(groups, path), F.col("anchor") == F.col("_group")).drop("_group")


CUT = "anchor long, content long, copies long, place long, data binary"
SPANS = "anchor long, content long, spans array<struct<begin: long, end: long>>"


def _sorted(cut: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """anchor, content, spans of regions or pieces by the order of their suffixes."""
    dealt = cut.drop("place").repartition("anchor").sortWithinPartitions("anchor", "content")
    return texts.map_batches(dealt, _sorted_shards(length, shard_bytes), SPANS)


def _of_large(cut: DataFrame, length: int, gram: int, shard_bytes: int, width: int, path: str) -> DataFrame:
    """anchor, content, spans of the regions or pieces of groups that are more than a shard."""
    cut = _written(cut, f"{path}/large-{width}")
    listed = _written(texts.map_batches(
        cut, _split(length, gram, width),
        "_anchor long, _content long, copies long, anchor long, content long, first long, strings long, place long"), f"{path}/pieces-{width}")
    repeated = _written(_repeated(listed, f"{path}/groups-{width}"), f"{path}/repeated-{width}")
    begin, end = F.col("first"), F.col("first") + F.col("strings") - 1 + length
    equal = repeated.filter("NOT differ").select("_anchor", "_content", begin.alias("begin"), end.alias("end"))

    differing = repeated.filter("differ")
    if width > 1 and not differing.isEmpty():
        one = differing.groupBy("anchor", "content").agg(
            F.sum("copies").alias("copies"), F.min(F.struct("_anchor", "_content", "first", "strings", "place")).alias("where"))
        one, any_large = _with_size(one.select("anchor", "content", "copies", "where.*"), length, shard_bytes, f"{path}/sizes-{width}")
        wanted = one.groupBy("_anchor", "_content").agg(F.collect_list(F.struct(
            "anchor", "content", "copies", "first", "strings", "place", "large")).alias("wanted"))
        held = (F.col("anchor") == F.col("_anchor")) & (F.col("content") == F.col("_content"))
        chosen = _written(cut.select("anchor", "content", "data").join(wanted, held).select("data", "wanted"), f"{path}/wanted-{width}")
        found = _sorted(texts.map_batches(chosen, _cut_pieces(length, False), CUT), length, shard_bytes)
        if any_large:
            larger = texts.map_batches(chosen, _cut_pieces(length, True), CUT)
            found = found.unionByName(_of_large(larger, length, gram, shard_bytes, -(-width // DISTANCE_PARTS), path))
        found = _written(found, f"{path}/found-{width}").toDF("_a", "_c", "spans")
        inner = differing.join(found, (F.col("anchor") == F.col("_a")) & (F.col("content") == F.col("_c"))).select(
            "_anchor", "_content", "first", F.explode("spans").alias("span"))
        equal = equal.unionByName(inner.select("_anchor", "_content", (F.col("first") + F.col("span.begin")).alias("begin"),
                                               (F.col("first") + F.col("span.end")).alias("end")))
    spans = equal.groupBy("_anchor", "_content").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    return spans.select(F.col("_anchor").alias("anchor"), F.col("_content").alias("content"), "spans")


def repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """k1, k2 of every text that loses bytes, n_removed, n_spans, kept_sha256 and the stretches `removed`."""
    spark = documents.sparkSession
    path = scratch_path(spark, "suffixes")
    given = _keyed(documents)
    listed = _written(texts.map_batches(given, _listed(length, gram), "k1 long, k2 long, anchor long, content long, first long, strings long"),
                      f"{path}/regions")
    # written, as a grouping right behind the join would keep a frequent anchor in one task
    repeated = _written(_repeated(listed, f"{path}/groups"), f"{path}/joined")
    # copies of a document list the same regions
    repeated = _written(repeated.groupBy(*KEY, "anchor", "content", "first", "strings", "differ").agg(F.count("*").alias("copies")),
                        f"{path}/repeated")

    differing = repeated.filter("differ")
    one = differing.groupBy("anchor", "content").agg(
        F.sum("copies").alias("copies"), F.min(F.struct(*KEY, "first", "strings")).alias("where"))
    one, any_large = _with_size(one.select("anchor", "content", "copies", "where.*"), length, shard_bytes, f"{path}/sizes")
    wanted = one.groupBy(*KEY).agg(F.collect_list(F.struct("anchor", "content", "first", "strings", "copies", "large")).alias("wanted"))
    affected = repeated.select(*KEY).distinct().join(wanted, KEY, "left")
    # copies are combined before the one shuffle of texts
    whole = given.groupBy(*KEY).agg(F.min("text").alias("text"))
    whole = _written(whole.join(affected, KEY), f"{path}/texts")

    held = whole.filter("wanted IS NOT NULL")
    sorted_ = _sorted(texts.map_batches(held, _cut_out(length, False), CUT), length, shard_bytes)
    if any_large:
        large = texts.map_batches(held.filter(F.exists("wanted", lambda w: w["large"])), _cut_out(length, True), CUT)
        width = -(-(length - gram + 1) // DISTANCE_PARTS)
        sorted_ = sorted_.unionByName(_of_large(large, length, gram, shard_bytes, width, path))
    # a region met again by a retried task has the same spans
    found = _written(sorted_, f"{path}/found").withColumnsRenamed({"anchor": "_anchor", "content": "_content"})
    inner = differing.join(found, (F.col("anchor") == F.col("_anchor")) & (F.col("content") == F.col("_content")))
    inner = inner.select(*KEY, "first", F.explode("spans").alias("span")).select(
        *KEY, (F.col("first") + F.col("span.begin")).alias("begin"), (F.col("first") + F.col("span.end")).alias("end"))
    equal = repeated.filter("NOT differ").select(
        *KEY, F.col("first").alias("begin"), (F.col("first") + F.col("strings") - 1 + length).alias("end"))
    spans = equal.unionByName(inner).groupBy(*KEY).agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    return texts.map_batches(
        whole.select(*KEY, "text").join(spans, KEY), _digests,
        "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<begin: long, end: long>>")


def document_repeats(documents: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    found = _written(repeats(documents, **options).drop("removed"), scratch_path(documents.sparkSession, "suffixes"))
    told = _keyed(documents, "doc_id").select(
        "doc_id", *KEY, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("_sha256"))
    return told.join(found, KEY, "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("kept_sha256", "_sha256").alias("kept_sha256"))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [[(s["begin"], s["end"]) for s in told or []] for told in batch.column("removed").to_pylist()]
        # a cut may fall inside a character; what is left of it goes
        kept = [t if not s else kept_bytes(t, s).decode("utf-8", "ignore") for t, s in zip(batch.column("text").to_pylist(), spans)]
        yield pa.record_batch([batch.column("row"), pa.array(kept, pa.string())], names=["row", "text"])


def without_repeats(documents: DataFrame, **options) -> DataFrame:
    """The documents with their columns, repeated strings cut out of `text`."""
    found = repeats(documents, **options).select(*KEY, "removed")
    rows = documents.select(F.struct("*").alias("row"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    met = rows.join(found, (F.xxhash64(text) == F.col("k1")) & (F.xxhash64(F.lit(1), text) == F.col("k2")), "left")
    given = met.select("row", F.col("row.text").alias("text"), "removed")
    kept = given.mapInArrow(_without, f"row {dict(given.dtypes)['row']}, text string")
    return kept.select(F.col("row").withField("text", F.col("text")).alias("row")).select("row.*")
