"""Audit of how far the sources of a language diverge in their words.

Every source's smoothed term probabilities are compared with those of each
other source of the language (sum of absolute differences) and with the
language's own (the terms that the source overuses most).

The second list needs no full sort. Its value rises with the count in the
source and falls with the count in the language, and equal values are listed
by the term's UTF-8 bytes. So a term dominated by k others (count in the
source no less, in the language no more, earlier bytes) cannot be among the
first k. Each task keeps the skyband of its share, the terms dominated by
fewer than k others; the skybands of a group are merged and cut again, and
what is left is ranked exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.blocks import plain_texts, row_blocks
from tessera.llm.common import column_of, staged

#: Probabilities are integers of this scale; every count is raised by SMOOTH.
SCALE, SMOOTH = 1_000_000_000, 5
#: (group, term) counts that a task adds up before it passes them on.
TASK_ROWS = 1 << 20
#: Sources of a tile; rows of a language that a task compares, about (more
#: where there are many sources, as every task gives a row for each pair).
TILE, SHARE_ROWS = 256, 1 << 14
#: Shares of a group whose skybands are merged apart from each other.
MERGES = 8
#: Rows compared with the kept ones at once.
STEP = 256
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _terms(texts: pa.Array) -> pa.ListArray:
    """Runs of ASCII letters (lower-cased) and other than ASCII characters."""
    _, offsets, data = texts.buffers()
    plain = pa.py_buffer((data.to_pybytes() if data else b"").translate(_TO_WORDS))
    return pc.split_pattern(pa.StringArray.from_buffers(len(texts), offsets, plain), " ")


def _block_counts(group: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(group, term, occurrences, rows with the term) of a block of texts."""
    parts = _terms(texts)
    coded = parts.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
    term, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    real = pc.greater(pc.binary_length(names), 0).to_numpy(zero_copy_only=False)[term] if len(names) else np.zeros(0, bool)
    width = max(len(names), 1)
    in_row, n = np.unique(row[real] * width + term[real], return_counts=True)
    key, at = np.unique(group[in_row // width] * width + in_row % width, return_inverse=True)
    total = np.bincount(at, n, len(key)).astype(np.int64)
    return key // width, names.take(pa.array(key % width)), total, np.bincount(at, minlength=len(key))


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and rows of each term in each
    group, and one row with a null term for each group. Tasks add up first, so
    a common word or a hot source comes from each task a few times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def added() -> pa.Table:
            keys = ["lang", "source", "term"]
            return pa.concat_tables(held).group_by(keys).aggregate([("n", "sum"), ("docs", "sum")]).rename_columns([*keys, "n", "docs"])

        for b in batches:
            texts = plain_texts(column_of(b, "text"))
            for i, j in row_blocks(texts):
                pair = pa.table({c: plain_texts(column_of(b, c)[i:j]) for c in ("lang", "source")})
                code = [pair[c].combine_chunks().dictionary_encode() for c in ("lang", "source")]
                wide = len(code[1].dictionary)
                groups, group = np.unique(code[0].indices.to_numpy().astype(np.int64) * wide + code[1].indices.to_numpy(), return_inverse=True)
                lang, source = code[0].dictionary.take(pa.array(groups // wide)), code[1].dictionary.take(pa.array(groups % wide))
                g, term, n, rows = _block_counts(group, plain_texts(texts[i:j]))
                zero = pa.array(np.zeros(len(groups), np.int64))
                held.append(pa.table([lang, source, pa.nulls(len(groups), pa.string()), zero, zero], ["lang", "source", "term", "n", "docs"]))
                g = pa.array(g)
                held.append(pa.table([lang.take(g), source.take(g), term, pa.array(n), pa.array(rows, pa.int64())], ["lang", "source", "term", "n", "docs"]))
                if sum(map(len, held)) > TASK_ROWS:
                    held = [added()]
                    if len(held[0]) > TASK_ROWS // 2:
                        yield from held.pop().combine_chunks().to_batches()
        if held:
            yield from added().combine_chunks().to_batches()

    src = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(k) for k, c in (("lang", lang_col), ("source", source_col), ("text", text_col))))
    out = src.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return out.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms)), exactly."""
    top = (count + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", top, (total + SMOOTH * terms).cast("decimal(20,0)")) + 1


def in_skyband(rows: np.ndarray, kept: np.ndarray, k: int) -> np.ndarray:
    """Which of ``rows`` fewer than k others dominate, as a mask.

    Columns: count in the group, count in the language, place of the term;
    ``rows`` come by the first descending, the others ascending, ``kept`` are
    the skyband of what came before, by count in the language. Counting the
    kept ones alone is enough: of k dominators that are not all kept, the
    first k in order are. Only those with no greater count in the language
    are looked at: few where both counts rise together, and where they do
    not, few are kept."""
    out = []
    for at in range(0, len(rows), STEP):
        part = rows[at : at + STEP]
        near = kept[: np.searchsorted(kept[:, 1], part[:, 1].max(), "right")]
        seen = np.concatenate([near, part])
        above = (seen[None, :, 0] >= part[:, 0, None]) & (seen[None, :, 1] <= part[:, 1, None]) & (seen[None, :, 2] < part[:, 2, None])
        out.append(above.sum(axis=1) < k)
        kept = np.concatenate([kept, part[out[-1]]])
        kept = kept[np.argsort(kept[:, 1], kind="stable")]
    return np.concatenate(out)


def skybands(rows: DataFrame, k: int) -> DataFrame:
    """Of (lang, source, term, n, lang_n) the rows that fewer than k others of
    their group in the same partition dominate. Memory holds one Arrow batch
    and the skyband of one group's share."""
    columns = ["lang", "source", "term", "n", "lang_n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, kept, names = None, np.zeros((0, 3), np.int64), []
        for b in batches:
            lang, source, term = (column_of(b, c).to_pylist() for c in columns[:3])
            n, lang_n = (column_of(b, c).to_numpy() for c in columns[3:])
            keys = list(zip(lang, source))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)] if keys else []
            keep = []
            for i, j in zip(cuts, cuts[1:]):
                if keys[i] != group:
                    group, kept, names = keys[i], np.zeros((0, 3), np.int64), []
                # the third column is the term's place in UTF-8 order among the kept ones and these
                words = names + [t.encode() for t in term[i:j]]
                place = np.empty(len(words), np.int64)
                place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
                own = np.stack([n[i:j], lang_n[i:j], place[len(names) :]], axis=1)
                kept[:, 2] = place[: len(names)]
                by_lang = np.argsort(kept[:, 1], kind="stable")
                at = np.flatnonzero(in_skyband(own, kept[by_lang], k))
                keep.append(at + i)
                names = names + [words[len(names) + x] for x in at.tolist()]
                kept = np.concatenate([kept, own[at]])
            yield b.take(pa.array(np.concatenate(keep) if keep else [], pa.int64()))

    ordered = rows.select(*columns).sortWithinPartitions("lang", "source", F.desc("n"), "lang_n", "term")
    return ordered.mapInArrow(run, "lang string, source string, term string, n long, lang_n long")


def _tile_sums(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, i, j, part): for sources i < j of a language, the sum over the
    terms of |p_i - p_j| less what it is where neither has the term.

    A task gets one share of a language's terms for two tiles of sources, with
    a row without a term for every source, and fills matrices of tile x terms;
    shares are added up afterwards."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        lang, left, right = key[0].as_py(), key[1].as_py(), key[2].as_py()
        number, none, p = (table[c].to_numpy() for c in ("number", "none", "p"))
        term = pc.fill_null(table["term"].combine_chunks().dictionary_encode().indices, -1).to_numpy()
        tiles = []
        for tile in sorted({left, right}):
            own = number // TILE == tile
            ids, first, row = np.unique(number[own], return_index=True, return_inverse=True)
            tiles.append((ids, none[own][first], row, term[own], p[own]))
        sums = np.zeros((len(tiles[0][0]), len(tiles[-1][0])), np.int64)
        width = int(term.max()) + 1
        for at in range(0, width, 4096):  # terms of the share, a stretch at a time
            full = []
            for ids, base, row, t, value in tiles:
                m = np.repeat(base[:, None], min(4096, width - at), axis=1)
                here = (t >= at) & (t < at + 4096)
                m[row[here], t[here] - at] = value[here]
                full.append(m)
            for x in range(len(full[0])):
                sums[x] += np.abs(full[-1] - full[0][x]).sum(axis=1) - np.abs(tiles[-1][1] - tiles[0][1][x]) * full[0].shape[1]
        a, b = (np.repeat(tiles[0][0], len(tiles[-1][0])), np.tile(tiles[-1][0], len(tiles[0][0])))
        use = a < b
        return pa.table({"lang": pa.array([lang] * int(use.sum()), pa.string()), "i": a[use].astype(np.int64), "j": b[use].astype(np.int64), "part": sums.ravel()[use]})

    tile = F.floor(F.col("number") / TILE).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.floor((F.col("sources") - 1) / TILE).cast("int")))
    held = F.least("sources", F.lit(2 * TILE))
    shares = (F.floor(F.col("terms") * held / F.greatest(F.lit(SHARE_ROWS), 4 * held * held)) + 1).cast("long")
    rows = rows.withColumn("share", F.pmod(F.xxhash64("term"), shares))
    every = groups.filter("terms > 0").withColumns({"term": F.lit(None).cast("string"), "p": F.col("none"), "share": F.explode(F.sequence(F.lit(0).cast("long"), shares - 1))})
    spread = rows.unionByName(every.select(rows.columns)).withColumn("tile", tile).withColumn("other", other)
    spread = spread.withColumns({"left": F.least("tile", "other"), "right": F.greatest("tile", "other")})
    parts = spread.groupBy("lang", "left", "right", "share").applyInArrow(run, "lang string, i long, j long, part long")
    return parts.groupBy("lang", "i", "j").agg(F.sum("part").alias("part"))


def source_divergence(docs: DataFrame, least_docs: int = 30, top: int = 50, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, part, item, value, rank.

    A language keeps the terms of at least ``least_docs`` of its rows. Part
    ``pair`` lists every other source of the language by its distance over
    the kept terms, part ``term`` the ``top`` kept terms whose probability in
    the source exceeds the language's most; ranks are by value descending,
    then by the item's UTF-8 bytes.

    Null texts, languages and sources count as ''; groups without terms take
    part with the smoothing alone; a language with one source has no pairs;
    repeated rows count as often as they come; an empty table gives no rows;
    other columns are ignored, whatever their names. Very long texts are
    handled whole."""
    counts = staged(term_counts(docs, lang_col, source_col, text_col), "source-terms")
    real = counts.filter("term IS NOT NULL")
    kept = real.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least_docs).drop("docs")
    kept = staged(kept, "source-kept-terms")
    rows = staged(real.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "source-kept-rows")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = Window.partitionBy("lang")
    groups = counts.filter("term IS NULL").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "terms", "lang_total")))
    groups = groups.withColumn("number", F.row_number().over(by_lang.orderBy("source")).cast("long") - 1).withColumn("sources", F.count("*").over(by_lang))
    # with no kept terms nothing is summed; the divisor only must not be zero
    groups = staged(groups.withColumn("none", probability(F.lit(0).cast("long"), F.col("total"), F.greatest("terms", F.lit(1)))), "source-groups")

    q = probability(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    of_term = rows.join(groups, ["lang", "source"]).withColumn("p", probability(F.col("n"), F.col("total"), F.col("terms"))).withColumn("over", F.col("p") - q)
    # a term above its language's probability is only dominated by such terms
    bands = skybands(of_term.filter("over > 0"), top)
    bands = skybands(bands.repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(MERGES))), top).join(groups, ["lang", "source"])
    over = probability(F.col("n"), F.col("total"), F.col("terms")) - q
    above = bands.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), over.alias("value"))

    sums = _tile_sums(of_term.select("lang", "term", "number", "sources", "terms", "none", "p"), groups)
    a, b = (groups.select("lang", *(F.col(c).alias(f"{c}_{s}") for c in ("source", "number", "none", "terms"))) for s in ("a", "b"))
    pairs = a.join(b, "lang").filter("number_a <> number_b")
    pairs = pairs.withColumns({"i": F.least("number_a", "number_b"), "j": F.greatest("number_a", "number_b")}).join(sums, ["lang", "i", "j"], "left")
    value = F.abs(F.col("none_a") - F.col("none_b")) * F.col("terms_a") + F.coalesce("part", F.lit(0))
    pairs = pairs.select("lang", F.col("source_a").alias("source"), F.lit("pair").alias("part"), F.col("source_b").alias("item"), value.alias("value"))

    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    terms = above.withColumn("rank", rank).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", rank).unionByName(terms).select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")
