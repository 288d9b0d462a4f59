"""Passages inside longer texts that stand elsewhere too, wherever in their lines.

Each window of `least` words is compared by the MinHash of its runs of SEED words, in one band of one row: equal windows
share it always, similar ones with the probability of their similarity, and neighbouring windows mostly have the same
one, so that a text has about 2 / (least - SEED + 2) of them a word. A passage of 22 words or more that is similar to
another at 80 percent has an unchanged window of 20 somewhere, so its recall is 1 there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicspark.llm.joins import spread_join
from civicspark.llm.words import mix, text_blocks, word_hashes, word_spans
from civicspark.session import cut, drop_cut, reading

SEED = 8
TILE = 128  # words of a kept text that are compared at once
MARGIN = 40  # words beside a tile
_ODD = np.uint64(0x9E3779B97F4A7C15)


def grams(words: np.ndarray, k: int, at: np.ndarray | None = None) -> np.ndarray:
    """A hash of each run of `k` words, or of those that start `at` these words."""
    n = max(0, len(words) - k + 1)
    out = np.zeros(n if at is None else len(at), np.uint64)
    for j, factor in enumerate(mix(np.arange(1, k + 1, dtype=np.uint64) * _ODD) | np.uint64(1)):
        out += (words[j : j + n] if at is None else words[at + j]) * factor
    return mix(out)


def windows(words: np.ndarray, first: np.ndarray, least: int, around: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of `least` words inside a text, or those that hold a run that starts at a word of `around`: their
    first word, and the first word and the hash of their least run."""
    if around is None:
        starts = np.flatnonzero(np.repeat(first[1:], np.diff(first)) - np.arange(len(words)) >= least)
    else:
        text = np.searchsorted(first, around, "right") - 1
        starts = around[:, None] - np.arange(least - min(SEED, least) + 1)
        starts = np.unique(starts[(starts >= first[text, None]) & (starts + least <= first[text + 1, None])])
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    size = min(SEED, least)
    runs = grams(words, size)
    at = starts + np.lib.stride_tricks.sliding_window_view(runs, least - size + 1)[starts].argmin(axis=1)
    return starts, at, runs[at]


def _words_of(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for row, data, offsets in text_blocks(texts):
        begins, ends, first = word_spans(data, offsets)
        yield row, data, offsets, begins, ends, first, word_hashes(data, begins, ends)


def _minima(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, *_, first, words in _words_of(batch.column(2)):
                _, at, keys = windows(words, first, least)
                at, one = np.unique(at, return_index=True)
                text = np.searchsorted(first, at, "right") - 1
                rows = pa.array(row + text)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array((at - first[text]).astype(np.int32)), pa.array(keys[one].view(np.int64))], names=["doc", "version", "pos", "key"])

    return run


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes of the words of tiles and beside them, cut to 32 bits, and where in the text these words begin and end."""
    for batch in batches:
        wanted = batch.column(3)
        for row, data, offsets, begins, ends, first, words in _words_of(batch.column(2)):
            points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
            short, texts, tiles, spans = words.astype(np.uint32).view(np.int32), [], [], []
            for text in range(len(first) - 1):
                for tile in wanted[row + text].as_py():
                    spans.append((first[text] + max(0, tile * TILE - MARGIN), min(first[text + 1], first[text] + (tile + 1) * TILE + MARGIN)))
                    texts.append(text)
                    tiles.append(tile)
            for a in range(0, len(spans), 2000):
                own, text = spans[a : a + 2000], np.array(texts[a : a + 2000])
                sizes, rows = [y - x for x, y in own], pa.array(row + text)
                zero = np.repeat(points[offsets[text]], sizes)
                cut_ = lambda v: np.concatenate([v[x:y] for x, y in own])  # noqa: B023, E731
                lists = lambda v: pa.ListArray.from_arrays(np.r_[0, np.cumsum(sizes)].astype(np.int32), v.astype(np.int32))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(tiles[a : a + 2000], pa.int32()), lists(cut_(short)), lists(points[cut_(begins)] - zero), lists(points[cut_(ends)] - zero)],
                    names=["hub_doc", "hub_version", "tile", "words", "begins", "ends"],
                )


def _similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    one, two = np.unique(one), np.unique(two)
    common = len(np.intersect1d(one, two, True))
    return common * 100 >= percent * (len(one) + len(two) - common)


def widened(x: np.ndarray, y: np.ndarray, keys_x: np.ndarray, keys_y: np.ndarray, at_x: int, at_y: int, size: int, width: int, percent: int, left_edits: bool = True) -> tuple[int, int, int, int]:
    """(start in x, stop in x, start in y, stop in y) of the longest passages found around the equal words
    x[at_x : at_x + size], y[at_y : at_y + size] that are similar enough: 100 * |A and B| >= percent * |A or B| of
    `width`-word shingles, whose hashes are `keys_x` and `keys_y`.

    Takes the equal words to both sides first. Then goes from one equal stretch to the next on either side (to the left
    only with `left_edits`), while similarity lasts; an edit may skip a quarter of the words.
    """
    sides = [[x[:at_x][::-1], y[:at_y][::-1], 0, 0], [x[at_x + size :], y[at_y + size :], 0, 0]]

    def stretch(side: list, i: int, j: int) -> int:
        most = min(len(side[0]) - i, len(side[1]) - j)
        apart = side[0][i : i + most] != side[1][j : j + most]
        return int(apart.argmax()) if apart.any() else most

    for side in sides:
        side[2] = side[3] = stretch(side, 0, 0)
    before, after = sides
    exact = (at_x - before[2], at_x + size + after[2], at_y - before[3], at_y + size + after[3])
    left = right = size + before[2] + after[2]
    common = max(1, left - width + 1)
    open_sides = [(side, k) for k, side in enumerate(sides) if (k or left_edits) and min(len(side[0]) - side[2], len(side[1]) - side[3]) > width]
    beside = lambda keys, at, k: keys[at + size :] if k else keys[: at - width + 1][::-1]
    keys = {k: (beside(keys_x, at_x, k), beside(keys_y, at_y, k)) for _, k in open_sides}
    moved, edits = True, False
    while moved:
        moved = False
        for side, k in open_sides:
            (kx, ky), (_, _, i, j), most = keys[k], side, 5 + left // 4
            u, v = np.nonzero(kx[i : i + most, None] == ky[None, j : j + most])
            if not len(u):
                continue
            best = np.maximum(u, v).argmin()
            u, v = int(u[best]), int(v[best])
            more = stretch(side, i + u, j + v)
            c, a, b = common + more - width + 1, left + u + more, right + v + more
            if c * 100 >= percent * (a + b - 2 * (width - 1) - c):
                side[2], side[3], common, left, right, moved, edits = i + u + more, j + v + more, c, a, b, True, True
    if not edits:
        return exact
    out = (at_x - before[2], at_x + size + after[2], at_y - before[3], at_y + size + after[3])
    return out if _similar(keys_x[out[0] : out[1] - width + 1], keys_y[out[2] : out[3] - width + 1], percent) else exact


class _Runs:
    """A column of lists of runs, read as arrays."""

    def __init__(self, column: pa.ListArray):
        runs = column.values
        self.first = column.offsets.to_numpy()
        self.hub_doc, self.hub_version, self.tile = (runs.field(c).to_numpy() for c in ("hub_doc", "hub_version", "tile"))
        words, hits = runs.field("words"), runs.field("hits")
        self.word_first, self.words = words.offsets.to_numpy(), words.values.to_numpy().view(np.uint32)
        self.hit_first = hits.offsets.to_numpy()
        self.pos, self.hub_pos = (hits.values.field(c).to_numpy() for c in ("pos", "hub_pos"))

    def of(self, row: int, width: int) -> Iterator[tuple[tuple[int, int], int, np.ndarray, np.ndarray, list[int], list[int]]]:
        """The runs of one text: its kept text, tile, the tile's words and their shingles, places in both; by kept text
        and tile. The shingles of a text's tiles are hashed at once, unless they are very many."""
        own = np.arange(self.first[row], self.first[row + 1])
        zero = self.word_first[self.first[row]]
        at_once = grams(self.words[zero : self.word_first[self.first[row + 1]]], width) if len(own) <= 2000 else None
        for k in own[np.lexsort((self.tile[own], self.hub_version[own], self.hub_doc[own]))]:
            hits = np.arange(self.hit_first[k], self.hit_first[k + 1])
            hits = hits[np.argsort(self.pos[hits], kind="stable")]
            a, b = self.word_first[k], self.word_first[k + 1]
            keys = grams(self.words[a:b], width) if at_once is None else at_once[a - zero : max(a, b - width + 1) - zero]
            yield (int(self.hub_doc[k]), int(self.hub_version[k])), int(self.tile[k]), self.words[a:b], keys, self.pos[hits].tolist(), self.hub_pos[hits].tolist()


_FOUND = "doc long, version long, start int, stop int, key long, hub_doc long, hub_version long, tile int, hub_start int, hub_stop int"


def _verified(least: int, width: int, percent: int):
    """For each text and its runs: passages that its counterpart confirms; and where an anchor has no such passage, the
    windows of `least` words around it with a hash of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, versions, runs = batch.column(0).to_pylist(), batch.column(1).to_pylist(), _Runs(batch.column(3))
            for row, data, offsets, begins, ends, first, words in _words_of(batch.column(2)):
                points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
                short = words.astype(np.uint32)
                shingles, gone, alone, out = grams(short, width), bytearray(len(words)), [], []
                for text, (begin, end) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
                    who = (docs[row + text], versions[row + text])
                    for hub, tile, y, keys_y, hits, hub_hits in runs.of(row + text, width):
                        lo = max(0, tile * TILE - MARGIN)
                        for at, at_hub in zip(hits, hub_hits, strict=True):
                            at += begin
                            if gone.find(0, at, at + SEED) < 0:
                                continue
                            k = at_hub - lo
                            base = max(begin, at - k - MARGIN)
                            x = short[base : min(end, at + len(y) - k + MARGIN)]
                            if x[at - base : at - base + SEED].tobytes() != y[k : k + SEED].tobytes():
                                continue
                            keys_x = shingles[base : max(base, base + len(x) - width + 1)]
                            a, b, c, d = widened(x, y, keys_x, keys_y, at - base, k, SEED, width, percent, hub != who)
                            if b - a < least:
                                alone.append(at)
                                continue
                            stop = base + b
                            gone[min(base + a, at) : stop] = bytes([1]) * (stop - min(base + a, at))
                            a = max(base + a, begin + lo + c + least if hub == who else 0)  # of overlapping repeats the first window stays
                            if a < stop:
                                out.append((text, a, stop, *hub, tile, lo + c, lo + d))
                ints = lambda v: pa.array(np.asarray(v, np.int32))

                def rows(text, start, stop, key, hub_doc, hub_version, tile, c, d):
                    zero, of = points[offsets[text]], pa.array(text + row)  # noqa: B023
                    ends_at = (ints(points[begins[start]] - zero), ints(points[ends[stop - 1]] - zero))  # noqa: B023
                    return pa.RecordBatch.from_arrays(
                        [batch.column(0).take(of), batch.column(1).take(of), *ends_at, key, hub_doc, hub_version, tile, ints(c), ints(d)],  # noqa: B023
                        names=["doc", "version", "start", "stop", "key", "hub_doc", "hub_version", "tile", "hub_start", "hub_stop"],
                    )

                for k in range(0, len(out), 20000):
                    text, a, b, hub_doc, hub_version, tile, c, d = (np.array(v) for v in zip(*out[k : k + 20000], strict=True))
                    yield rows(text, a, b, pa.nulls(len(a), pa.int64()), pa.array(hub_doc), pa.array(hub_version), ints(tile), c, d)
                alone = np.array([at for at in alone if gone.find(0, at, at + SEED) >= 0], np.int64)
                if len(alone):
                    mark = np.zeros(len(words), bool)
                    mark[alone] = True
                    starts, at, _ = windows(words, first, least, alone)
                    starts = starts[mark[at]]
                    for k in range(0, len(starts), 20000):
                        a = starts[k : k + 20000]
                        text, n = np.searchsorted(first, a, "right") - 1, len(a)
                        yield rows(text, a, a + least, pa.array(grams(words, least, a).view(np.int64)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), a - first[text], a - first[text] + least)

    return run


def with_texts(lists: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """(doc, version, text, name): each text once, with its list."""
    return lists.join(texts, ["doc", "version"]).groupBy("doc", "version").agg(F.first("text").alias("text"), F.first(name).alias(name))


def _followers(anchors: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """The anchors (doc, version, pos, key, *more) whose key stands at a smaller place too, with the smallest: hub_doc,
    hub_version, hub_pos, and hub_* of the columns `more`."""
    keys = cut(anchors.groupBy("key").agg(F.min("doc").alias("hub_doc"), F.count("*").alias("n")).where("n > 1"))
    hits = cut(spread_join(anchors, keys.select("key", "hub_doc"), ["key"], keys.select("key", "n"), ["doc", "pos"]))
    hubs = hits.where("doc = hub_doc").groupBy("key").agg(F.min(F.struct("version", "pos", *more)).alias("hub"))
    hubs = hubs.select("key", *[F.col(f"hub.{c}").alias(f"hub_{c}") for c in ("version", "pos", *more)])
    out = spread_join(hits, hubs, ["key"], keys.select("key", "n"), ["doc", "pos"]).where("not (doc = hub_doc and version = hub_version and pos = hub_pos)")
    return reading(out, keys, hits)


def _runs(placed: DataFrame) -> DataFrame:
    """(doc, version, hub_doc, hub_version, tile, hits): anchors of a text, one after the other, that follow one tile of one text."""
    own = Window.partitionBy("doc", "version").orderBy("pos")
    before = lambda c: F.lag(c).over(own)
    same = (before("hub_doc") == F.col("hub_doc")) & (before("hub_version") == F.col("hub_version")) & (before("tile") == F.col("tile"))
    near = (F.col("pos") - before("pos") <= MARGIN) & (F.abs(F.col("pos") - F.col("hub_pos") - before("pos") + before("hub_pos")) <= SEED)
    marked = placed.withColumn("tile", F.floor(F.col("hub_pos") / TILE).cast("int"))
    marked = marked.withColumn("new", F.when(same & near, 0).otherwise(1)).withColumn("run", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("doc", "version", "run", "hub_doc", "hub_version", "tile").agg(F.collect_list(F.struct("pos", "hub_pos")).alias("hits")).drop("run")


def repeated_passages(texts: DataFrame, least: int = 20, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc, version, start, stop, group, first_doc, kept) of the passages of `texts` (doc, version, text) that repeat.

    The windows of `least` words with one MinHash form a bucket; each is compared with the smallest (doc, version, place)
    of its bucket, a star. The words that both share there are widened to both sides, edits included, as far as the
    passage and its counterpart have similarity percent / 100 or more as sets of `width`-word shingles. A passage of
    `least` words or more is to be removed, so of near copies the first stays, whatever copies the others have. Windows
    whose star gives no passage (a common phrase in other surroundings) meet again in buckets of the whole window, so
    no two equal windows both stay. Of a repeat that overlaps itself the first window stays.

    Start and stop count characters from 0; passages can overlap. Each group, the passages that follow one kept stretch
    of one text, also has a row of its kept passage. Null docs take no part, nor do texts of fewer words. Hot windows
    are spread over tasks; a task holds one text with its own anchors.
    """
    texts = texts.where("doc is not null")
    anchors = cut(texts.mapInArrow(_minima(least), "doc long, version long, pos int, key long"))
    placed = _followers(anchors)
    drop_cut(anchors)
    runs = cut(_runs(placed))
    drop_cut(placed)
    tile = ["hub_doc", "hub_version", "tile"]
    sizes = cut(runs.groupBy(*tile).agg(F.count("*").alias("n")))
    wanted = sizes.groupBy(F.col("hub_doc").alias("doc"), F.col("hub_version").alias("version")).agg(F.collect_list("tile").alias("tiles"))
    tiles = cut(with_texts(wanted, texts, "tiles").mapInArrow(_tiles, "hub_doc long, hub_version long, tile int, words array<int>, begins array<int>, ends array<int>"))
    met = spread_join(runs, tiles.select(*tile, "words"), tile, sizes, ["doc", "version"])
    lists = met.groupBy("doc", "version").agg(F.collect_list(F.struct(*tile, "words", "hits")).alias("runs"))
    found = cut(with_texts(lists, texts, "runs").mapInArrow(_verified(least, width, percent), _FOUND))
    drop_cut(runs)
    alone = cut(found.where("key is not null").select("doc", "version", F.col("hub_start").alias("pos"), "key", "start", "stop").distinct())
    left = _followers(alone, ("start", "stop"))
    again = left.where(f"not (doc = hub_doc and version = hub_version and pos < hub_pos + {least})")
    row = ["doc", "version", "start", "stop", *tile, "hub_from", "hub_to", "hub_start", "hub_stop"]
    again = again.withColumnRenamed("hub_start", "hub_from").withColumnRenamed("hub_stop", "hub_to").withColumns({"tile": F.lit(None).cast("int"), "hub_start": F.col("hub_pos"), "hub_stop": F.col("hub_pos") + least})
    none = F.lit(None).cast("int")
    gone = cut(found.where("key is null").withColumns({"hub_from": none, "hub_to": none}).select(row).distinct().union(again.select(row)))
    for table in (found, alone, left):
        drop_cut(table)
    grouped = _grouped(gone, tiles)
    out = cut(grouped)
    for table in (grouped, gone, sizes, tiles):
        drop_cut(table)
    return out


def _grouped(gone: DataFrame, tiles: DataFrame) -> DataFrame:
    """Removed passages with the group of the kept stretch they follow, and a row for each kept one."""
    tile, claim = ["hub_doc", "hub_version", "tile"], ["hub_doc", "hub_version", "hub_start", "hub_stop"]
    counted = gone.groupBy(*claim, "tile", "hub_from", "hub_to").agg(F.count("*").alias("n"))
    before = F.greatest(F.lit(0), F.col("tile") * TILE - MARGIN)  # words of the text before the tile's own
    begin, end = F.element_at("begins", F.col("hub_start") - before + 1), F.element_at("ends", F.col("hub_stop") - before)
    placed = counted.join(tiles.drop("words"), tile, "left").select(*claim, "n", F.coalesce("hub_from", begin).alias("start"), F.coalesce("hub_to", end).alias("stop"))
    claims = placed.groupBy(*claim).agg(F.sum("n").alias("n"), F.min("start").alias("start"), F.max("stop").alias("stop"))
    own = Window.partitionBy("hub_doc", "hub_version").orderBy("hub_start", "hub_stop")
    new = F.coalesce(F.col("hub_start") >= F.max("hub_stop").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    head = F.last(F.when(F.col("new"), F.col("hub_start")), True).over(own.rowsBetween(Window.unboundedPreceding, 0))
    claims = cut(claims.withColumn("new", new).withColumn("group", F.xxhash64("hub_doc", "hub_version", head)).drop("new"))
    removed = spread_join(gone, claims.select(*claim, "group"), claim, claims.select(*claim, "n"), ["doc", "start"]).select("doc", "version", "start", "stop", "group", F.col("hub_doc").alias("first_doc"), F.lit(False).alias("kept"))
    kept = claims.groupBy("group", "hub_doc", "hub_version").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    kept = kept.select(F.col("hub_doc").alias("doc"), F.col("hub_version").alias("version"), "start", "stop", "group", F.col("hub_doc").alias("first_doc"), F.lit(True).alias("kept"))
    return reading(removed.union(kept), claims)
