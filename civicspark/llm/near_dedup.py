"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidates, exact confirmation."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicspark.llm.components import connected_components
from civicspark.llm.joins import looked_up, spread_join
from civicspark.llm.words import mix, shingle_hashes, text_blocks, word_hashes, word_spans
from civicspark.session import cut, drop_cut, reading

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def densifying_order(bins: int) -> np.ndarray:
    """For each bin the order in which it looks for a filled one; the same in every document."""
    own = np.arange(1, bins + 1, dtype=np.uint64)
    keys = mix(own[:, None] * np.uint64(0x9E3779B97F4A7C15) + mix(own)[None, :])
    keys[np.arange(bins), np.arange(bins)] = 0
    return np.argsort(keys, axis=1)


def signatures(shingles: np.ndarray, offsets: np.ndarray, bins: int, order: np.ndarray) -> np.ndarray:
    """[sets, bins]: the least hash in each of equal ranges of hash values; an empty bin borrows from a bin drawn for it.

    Set k is shingles[offsets[k] : offsets[k + 1]]; none may be empty.
    """
    sizes = np.diff(offsets)
    out = np.full((len(sizes), bins), _EMPTY)
    place = ((shingles >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    np.minimum.at(out.reshape(-1), np.repeat(np.arange(len(sizes)) * bins, sizes) + place.astype(np.int64), shingles)
    own = out.copy()
    row, bin_ = np.nonzero(own == _EMPTY)
    for k in range(1, bins):
        if not len(row):
            break
        found = own[row, order[bin_, k]]
        out[row, bin_] = found
        left = found == _EMPTY
        row, bin_ = row[left], bin_[left]
    return out


def band_keys(shingles: np.ndarray, offsets: np.ndarray, bands: int, rows: int, order: np.ndarray) -> np.ndarray:
    """[sets, bands]: a hash of each band of the signatures."""
    bins = signatures(shingles, offsets, bands * rows, order).reshape(-1, bands, rows)
    place = np.arange(1, rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(np.add.reduce(mix(bins + place), axis=2, dtype=np.uint64) + mix(np.arange(1, bands + 1, dtype=np.uint64)))


def distinct_sets(runs: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text, sorted, one text after the other; and the number of them before each text."""
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts), dtype=np.uint16 if len(counts) < 65536 else np.int64), counts)
    order = np.argsort(runs)
    order = order[np.argsort(text[order], kind="stable")]
    runs, text = runs[order], text[order]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:] != runs[:-1]) | (text[1:] != text[:-1])
    return runs[new], np.r_[0, np.cumsum(np.bincount(text[new], minlength=len(counts)))]


def document_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of texts as (first row, distinct shingle hashes, offsets)."""
    for row, data, offsets in text_blocks(texts):
        starts, ends, first = word_spans(data, offsets)
        yield row, *distinct_sets(*shingle_hashes(word_hashes(data, starts, ends), first, width))


def fingerprints(sets: np.ndarray, offsets: np.ndarray, bands: int, rows: int, order: np.ndarray) -> dict[str, pa.Array]:
    """n_shingles, one, two (a 128-bit fingerprint of the set) and bands of each set; an empty one has no bands."""
    sizes = np.diff(offsets)
    some = np.flatnonzero(sizes)
    one, two = np.zeros((2, len(sizes)), np.uint64)
    keys = np.zeros((0, bands), np.uint64)
    if len(some):
        one[some] = np.add.reduceat(mix(sets), offsets[some])
        two[some] = np.bitwise_xor.reduceat(mix(sets + np.uint64(7)), offsets[some])
        keys = band_keys(sets, np.r_[offsets[some], len(sets)], bands, rows, order)
    ends = np.r_[0, np.cumsum(np.where(sizes > 0, bands, 0))].astype(np.int32)
    return {
        "n_shingles": pa.array(sizes.astype(np.int64)), "one": pa.array(one.view(np.int64)), "two": pa.array(two.view(np.int64)),
        "bands": pa.ListArray.from_arrays(ends, keys.reshape(-1).view(np.int64)),
    }


def _signatures(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = densifying_order(bands * rows)
        for batch in batches:
            for row, sets, offsets in document_sets(batch.column(1), width):
                yield pa.RecordBatch.from_pydict({"id": batch.column(0).slice(row, len(offsets) - 1), **fingerprints(sets, offsets, bands, rows, order)})

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sets, offsets in document_sets(batch.column(1), width):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(offsets) - 1), pa.ListArray.from_arrays(offsets.astype(np.int32), sets.view(np.int64))], names=["id", "shingles"])

    return run


def _sets_of(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    own = texts_of(texts, wanted)
    return reading(own.mapInArrow(_sets(width), "id long, shingles array<long>"), own)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), a written table, whose full sets are similar enough. A b of many pairs is spread over tasks."""
    one = sets.selectExpr("id a", "shingles sa")
    two = sets.selectExpr("id b", "shingles sb")
    return (
        spread_join(pairs.join(one, "a"), two, ["b"], pairs.groupBy("b").agg(F.count("*").alias("n")), ["a"], total=pairs.count())
        .where(F.least(F.size("sa"), F.size("sb")) * 100 >= F.greatest(F.size("sa"), F.size("sb")) * percent)
        .withColumn("common", F.size(F.array_intersect("sa", "sb")).cast("long"))
        .where(F.col("common") * 100 >= (F.size("sa") + F.size("sb") - F.col("common")) * percent)
        .select("a", "b")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, bands: int = 24, rows: int = 5) -> DataFrame:
    """Groups of near-duplicate documents: (id, n_shingles, component_id, kept, class_id), one row per input row.

    Two documents are linked if 100 * |A and B| >= percent * |A or B| for their sets of `width`-word shingles.
    Documents with equal sets form a class, whose smallest id stands for it from then on, so copies never multiply.
    Members of a band bucket are compared with its smallest id (a star, so a bucket of n gives n - 1 candidates) and
    confirmed on full sets. Members of a star that still lie in different components go on to an exact search over
    their differences from its hub, so no link inside a bucket is lost to the star.

    With 24 bands of 5 rows a pair at similarity 0.8 shares no bucket with probability 7e-5, at 0.85 8e-7.

    Null or empty text, or no words: empty set, linked with nothing. Null id: founds no group, always kept. Rows
    with one id count as one document with several texts, each row is returned. Other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = cut(texts.mapInArrow(_signatures(width, bands, rows), "id long, n_shingles long, one long, two long, bands array<long>"))
    out = with_components(found, lambda wanted: _sets_of(texts, wanted, width), percent)
    rows = out.select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"),
        F.coalesce("class_id", "id").alias("class_id"),
    )
    return reading(rows, out)


_BITS = 1 << 15  # of a row of bitmap_construct_agg


def texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of texts whose id is among the distinct ids `wanted`. A bitmap of hashed ids, 16 bits for each, is broadcast
    first, so that of the other texts one in 16 at most is shuffled."""
    ids = cut(wanted)
    rows = ids.count() * 16 // _BITS + 1
    place = F.pmod(F.xxhash64("id"), F.lit(rows * _BITS))
    row, bit = F.floor(place / _BITS).cast("int"), F.pmod(place, F.lit(_BITS))
    marks = ids.groupBy(row.alias("row")).agg(F.bitmap_construct_agg(bit).alias("marks"))
    byte = F.conv(F.hex(F.substring(F.col("marks"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.expr("shiftright(byte, bit % 8) & 1") == 1
    some = texts.withColumns({"row": row, "bit": bit.cast("int")}).join(F.broadcast(marks), "row").withColumn("byte", byte).where(marked).select(*texts.columns)
    return reading(some.join(ids, "id").select(*texts.columns), ids)  # a semi join would be moved below the bitmap's


_CLASS = ["one", "two", "n_shingles"]


def with_components(found: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, shared_only: bool = False) -> DataFrame:
    """The rows of `found` (id, n_shingles, one, two, bands, ...) without bands, with class_id and component (null
    without id or shingles); with `shared_only` those alone that have equals or links. `sets_of` gives the full sets
    (id, shingles) of a table of ids.

    Each table that is written here is dropped after its last reader. `found` and what components are read from stay.
    """
    known = found.where("id is not null and n_shingles > 0")
    classes = cut(known.groupBy(*_CLASS).agg(F.min("id").alias("class_id"), F.count("*").alias("n")))
    # class ids are unique but for ids that repeat with other texts, whose keys then stand twice
    first = known.select("id", "bands", *_CLASS).join(classes.select(*_CLASS, F.col("class_id").alias("id")), ["id", *_CLASS], "left_semi")
    keys = cut(first.select("id", F.explode("bands").alias("key")))
    hubs = keys.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("n")).where("n > 1")
    hubs = cut(hubs)
    buckets = cut(spread_join(keys, hubs.select("key", "hub"), ["key"], hubs.select("key", "n"), ["id"]).select("id", "hub").distinct())
    _drop(keys, hubs)
    stars = cut(buckets.where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")))
    wanted = sets_of(buckets.select("id").distinct())
    sets = cut(wanted)
    _drop(wanted, buckets)
    links = cut(_confirmed(stars, sets, percent))
    labels = connected_components(links, "a", "b")
    rest = cut(_unsettled(stars, looked_up(labels)))
    _drop(stars)
    places = _early_places(rest, sets, percent)
    for pairs_of in (_bucket_stars, _bucket_pairs):
        if not places.isEmpty():
            places = _in_components(places, looked_up(labels), percent)
            pairs = cut(pairs_of(places, percent))
            more = cut(_confirmed(pairs, sets, percent))
            _drop(pairs)
            links = reading(links.union(more), links, more)
            if not more.isEmpty():
                _drop(labels)
                labels = connected_components(links, "a", "b")
    _drop(links, rest, places, sets)

    same = classes.join(looked_up(labels).withColumnRenamed("node", "class_id"), "class_id", "left")
    if shared_only:
        same = same.where("n > 1 or component is not null")
    same = same.select(*_CLASS, "class_id", F.coalesce("component", "class_id").alias("component"))
    out = spread_join(found.drop("bands"), same, _CLASS, classes.select(*_CLASS, "n"), ["id"], how="inner" if shared_only else "left")
    return reading(out, found, classes, labels)


def _drop(*tables: DataFrame) -> None:
    for table in tables:
        drop_cut(table)


def _unsettled(stars: DataFrame, labels: DataFrame) -> DataFrame:
    """(centre, id) of the stars whose members, centre included, are not all in one component."""
    of = lambda c: labels.selectExpr(f"node {c}", f"component of_{c}")
    placed = stars.join(of("a"), "a", "left").join(of("b"), "b", "left").select("a", "b", F.coalesce("of_a", "a").alias("ca"), F.coalesce("of_b", "b").alias("cb"))
    mixed = placed.groupBy("b").agg(F.min(F.least("ca", "cb")).alias("lo"), F.max(F.greatest("ca", "cb")).alias("hi")).where("lo < hi").select("b")
    return placed.join(mixed, "b").selectExpr("b centre", "a id")


def _early_places(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(centre, id, n, m, s, r): the elements s of the difference of each star's member from its centre that a link to
    a member of another component would have to share first.

    With t = percent / 100, sets x and y are linked if their difference has at most B = (1 - t) / (1 + t) (|x| + |y|)
    elements. Let dx and dy be their differences from the centre. In a pair from different components one member isn't
    linked to the centre, so |dx| + |dy| > B, and dx and dy must share (|dx| + |dy| - B) / 2 elements. In the order of
    rising frequency the first shared one then stands at place r with 2 (r - 1) <= |dx| - |dy| + B in dx, and so in dy.
    Copies that differ by their own edits share nothing so early, so a hot group makes no pairs among itself.
    """
    member = sets.selectExpr("id", "shingles sa")
    centre = sets.selectExpr("id centre", "shingles sh")
    apart = spread_join(rest.join(member, "id"), centre, ["centre"], rest.groupBy("centre").agg(F.count("*").alias("n")), ["id"], total=rest.count()).select(
        "centre", "id", F.size("sa").alias("n"),
        F.concat(F.array_except("sa", "sh"), F.transform(F.array_except("sh", "sa"), lambda x: F.bitwise_not(x))).alias("d"),
    )
    each = cut(apart.select("centre", "id", "n", F.size("d").alias("m"), F.explode("d").alias("s")))
    often = each.groupBy("centre", "s").agg(F.count("*").alias("c")).where("c > 1")
    own = Window.partitionBy("centre", "id")
    early = F.expr(f"(2L * (r - 1) - m) * {(100 + percent) * percent} <= {100 - percent}L * (n * {percent}L + n * 100L)")
    places = cut(
        spread_join(each, often, ["centre", "s"], often.withColumnRenamed("c", "n"), ["id"], total=each.count())
        .withColumn("r", F.col("m") - F.count("*").over(own) + F.row_number().over(own.orderBy("c", "s")))
        .where(early).select("centre", "id", "n", "m", "s", "r")
    )
    _drop(each)
    return places


def _in_components(places: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """The places of those buckets (centre, s) that members of several components share, without the members that no
    other one there can be linked to; with component, v, w and the bucket's ends. `places` is dropped.

    In the notes of _early_places a pair fits a bucket if w_x + v_y <= 0 and w_y + v_x <= 0, with v = m - b n,
    w = 2 (r - 1) - m - b n and b = (1 - t) / (1 + t). One of a pair lies outside the centre's component, so a member
    inside is held against the smallest v and w outside, a member outside against the smallest of all. Who stays then
    meets smaller buckets, so this is done twice. Of elements that the same members share the one that comes first in
    all of them stands for the others.
    """
    of = lambda c, to: labels.selectExpr(f"node {c}", f"component {to}")
    now = places.select("centre", "s", "id", "n", "m", "r").join(of("id", "of"), "id", "left").join(of("centre", "core"), "centre", "left")
    now = now.withColumns({
        "component": F.coalesce("of", "id"), "outside": F.coalesce("of", "id") != F.coalesce("core", "centre"),
        "v": F.expr(f"{100 + percent}L * m - {100 - percent}L * n"), "w": F.expr(f"{100 + percent}L * (2 * (r - 1) - m) - {100 - percent}L * n"),
    }).drop("of", "core")
    held, end, source = now.columns, F.struct("component", "id", "n", "v", "w"), places
    for _ in range(2):
        buckets = now.groupBy("centre", "s").agg(
            F.min(end).alias("lo"), F.max(end).alias("hi"), F.min("v").alias("v_all"), F.min("w").alias("w_all"), F.min(F.when(F.col("outside"), F.col("v"))).alias("v_out"), F.min(F.when(F.col("outside"), F.col("w"))).alias("w_out"),
            F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("size"), F.bit_xor(F.xxhash64("id")).alias("one"), F.sum(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 31))).alias("two"), F.sum("r").alias("rank"),
        ).where("lo.component < hi.component")
        best = F.min_by(F.struct("s", "lo", "hi", "v_all", "w_all", "v_out", "w_out"), F.struct("rank", "s")).alias("best")
        several = buckets.groupBy("centre", "first", "last", "size", "one", "two").agg(best).select("centre", "best.*")
        now = cut(
            now.join(several, ["centre", "s"])
            .where("w + if(outside, v_all, v_out) <= 0 and v + if(outside, w_all, w_out) <= 0")
            .select(*held, "lo", "hi")
        )
        drop_cut(source)
        source, now = now, now.select(held)
    return source


def _fits(percent: int) -> Column:
    """Whether members a and b of one bucket, of different components, can be linked by its element as their first shared one."""
    return F.expr(f"ca <> cb and wa + vb <= 0 and wb + va <= 0 and least(na, nb) * 100 >= greatest(na, nb) * {percent}")


def _bucket_stars(places: DataFrame, percent: int) -> DataFrame:
    """Each member with an end of its bucket (centre, s), of the first and of the last component, so that most links inside are found in linear time."""
    ends = places.selectExpr("id a", "component ca", "n na", "v va", "w wa", "inline(array(lo, hi)) as (cb, b, nb, vb, wb)")
    return ends.where(_fits(percent)).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _bucket_pairs(places: DataFrame, percent: int) -> DataFrame:
    """All pairs of a bucket (centre, s) that are still in different components and can be similar enough."""
    one, two = (places.selectExpr("centre", "s", f"id {x}", f"component c{x}", f"n n{x}", f"v v{x}", f"w w{x}") for x in "ab")
    return one.join(two, ["centre", "s"]).where((F.col("a") > F.col("b")) & _fits(percent)).select("a", "b").distinct()


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that near_duplicates keeps, and of rows equal in id and text one.

    Null ids are kept, one of each text; null and empty texts are kept by id. Columns of docs keep their names and
    values, whatever they are called; an empty table gives none. Texts are shuffled once, by id.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(f"`{text_col}`").alias("version"))
    found = near_duplicates(docs, id_col, text_col, **options)
    kept = cut(found.where("kept").select(F.col(f"`{id_col}`").alias("id")).where("id is not null").distinct())
    drop_cut(found)
    left = rows.join(kept.withColumn("kept", F.lit(True)), "id", "left").where("id is null or kept")
    return reading(left.dropDuplicates(["id", "version"]).select("row.*"), kept)
