"""Word tables: cleaning, line splitting, line assembly, page text, extents and skew.

A word row is page_id, word_no, text, conf, x, y, w, h, line_num. Everything is keyed by page_id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import folded

# Words of a long line that are placed in one go.
PIECE = 32
# Words of the batches of whole pages that are looked at column by column.
BATCH_WORDS = 1 << 17


def in_pages(words: DataFrame, read: Callable[[pa.Table, np.ndarray, pa.Table], pa.RecordBatch], schema: T.StructType, pages: DataFrame | None = None) -> DataFrame:
    """What read makes of batches of whole pages: it gets the words of some pages, in their order, the place at which each page begins (and after these the end), and a row for each page.

    Words stay where their pages are: no array of them is built, and pages that lie together already are not shuffled.
    pages: also these pages (page_id and what is known of each), with words or without; words of other pages are left out.
    """
    told = words.columns
    own = Window.partitionBy("page_id")
    if pages is None:
        rows = words.withColumn("page_words", F.count("*").over(own))
        about = ["page_id"]
    else:
        about = pages.columns
        if all(isinstance(pages.schema[c].dataType, T.NumericType) for c in about if c != "page_id"):
            # A merge leaves each page's words side by side.
            rows = words.join(pages.hint("merge"), "page_id", "right")
        else:
            # What is large comes with a page's first word only.
            first = words.withColumn("first_no", F.min("word_no").over(own)).join(pages.hint("merge"), "page_id", "right")
            rows = first.select(*told, *[F.when(F.col("word_no").eqNullSafe(F.col("first_no")), F.col(c)).alias(c) for c in about if c != "page_id"])

    def ordered(rows: pa.Table, starts: np.ndarray) -> pa.Table:
        page = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        no = rows["word_no"].cast(pa.float64()).to_numpy()
        if np.all((page[1:] > page[:-1]) | (no[1:] > no[:-1])):
            return rows
        return rows.take(pa.array(np.lexsort((no, page))))

    def whole(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        rows = ordered(rows.combine_chunks(), starts)
        about_pages = rows.select(about).take(pa.array(starts[:-1]))
        there = rows["word_no"].is_valid()
        if not pc.all(there).as_py():
            starts = np.r_[0, np.cumsum(there.to_numpy())][starts]
            rows = rows.filter(there)
        return read(rows.select(told), starts, about_pages)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held, enough = [], 0, BATCH_WORDS
        for batch in found:
            held.append(batch)
            n_held += batch.num_rows
            if n_held < enough:
                continue
            rows = pa.Table.from_batches(held)
            starts = page_starts(rows["page_id"])
            if len(starts) > 2:
                yield whole(rows.slice(0, starts[-2]), starts[:-1])
                rows = rows.slice(starts[-2])
            held, n_held = rows.to_batches(), len(rows)
            # A page that is longer than a batch is not put together again for each batch that it gains.
            enough = max(BATCH_WORDS, 2 * n_held)
        if n_held:
            rows = pa.Table.from_batches(held)
            yield whole(rows, page_starts(rows["page_id"]))

    return rows.mapInArrow(batches, schema)


def page_starts(ids: pa.ChunkedArray) -> np.ndarray:
    """Where the runs of equal page ids begin, and where the last of them ends."""
    if pa.types.is_nested(ids.type):
        held = ids.to_pylist()
        changes = np.array([a != b for a, b in zip(held[1:], held[:-1], strict=True)], bool)
    else:
        codes = ids.combine_chunks().dictionary_encode(null_encoding="encode")
        codes = (codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy(zero_copy_only=False)
        changes = codes[1:] != codes[:-1]
    return np.r_[0, 1 + np.flatnonzero(changes), len(ids)]


def clean_words(words: DataFrame, min_conf: float = 0.0) -> DataFrame:
    """Words with text and at least min_conf; a confidence that is no number counts as -1."""
    conf = F.coalesce(F.col("conf").try_cast("double"), F.lit(-1.0))
    return words.withColumn("conf", conf).where((F.trim("text") != "") & (F.col("conf") >= min_conf))


def line_words() -> tuple[Column, Column]:
    """The words of a line's text, and of its words (parts) and box the words with their places: structs of text, x and w."""
    space = "[\\\\x20\\\\x09-\\\\x0D]"
    # Lines of one word, the most of them, never meet the functions over arrays.
    parts = f"IF(rlike(text, '{space}'), filter(split(text, '{space}+'), p -> p <> ''), IF(text = '' OR text IS NULL, CAST(array() AS array<string>), array(text)))"
    # The width of a word is computed once (w1); the starts of the words after the first are what is kept, in pieces of a fixed number of words: an array is copied for each item that it gains.
    width = "greatest(1, CAST(rint((x + w - a.at) * char_length(p) / a.chars) AS int))"
    step = f"(a, p) -> element_at(transform(array({width}), w1 -> named_struct('at', a.at + w1, 'chars', a.chars - CAST(char_length(p) AS int), 'out', array_append(a.out, a.at + w1))), 1)"
    piece = f"aggregate(slice(parts, {PIECE} * c + 1, least({PIECE}, size(parts) - 1 - {PIECE} * c)), named_struct('at', b.at, 'chars', b.chars, 'out', CAST(array() AS array<int>)), {step})"
    starts = (
        f"flatten(aggregate(sequence(0, (size(parts) - 2) div {PIECE}), named_struct('at', x, 'chars', CAST(char_length(array_join(parts, '')) AS int), 'out', array(array(x))), "
        f"(b, c) -> element_at(transform(array({piece}), a -> named_struct('at', a.at, 'chars', a.chars, 'out', array_append(b.out, a.out))), 1), b -> b.out))"
    )
    placed = (
        "IF(size(parts) = 1, array(named_struct('text', parts[0], 'x', x, 'w', greatest(1, w))), "
        f"transform(array({starts}), s -> transform(parts, (p, i) -> named_struct('text', p, 'x', s[i], 'w', greatest(1, coalesce(get(s, i + 1), x + w) - s[i]))))[0])"
    )
    return F.expr(parts), F.expr(placed)


HAS_WORD = "[^\\x20\\x09-\\x0D]"


def lines_to_words(lines: DataFrame) -> DataFrame:
    """Words of text lines (page_id, line_no, text, conf and box): the width left is shared by the characters left.

    word_no follows (y, x) on the page, then the word's place in its line. Lines without a word give no row.
    """
    parts, placed = line_words()
    split = lines.where(F.rlike("text", F.lit(HAS_WORD))).withColumn("parts", parts)
    cut = split.select("page_id", "line_no", "conf", "y", "h", placed.alias("words"))
    rows = cut.select("page_id", "line_no", "conf", "y", "h", F.posexplode_outer("words").alias("part_no", "v"))
    order = Window.partitionBy("page_id").orderBy("y", "v.x", "line_no", "part_no")
    return rows.select(
        "page_id", (F.row_number().over(order) - 1).alias("word_no"), F.col("v.text").alias("text"), "conf", F.col("v.x").alias("x"), "y", F.col("v.w").alias("w"), "h", F.lit(1).alias("block_num"), F.lit(1).alias("par_num"), F.col("line_no").alias("line_num")
    )


def with_extents(words: DataFrame) -> DataFrame:
    """words with the extents of their page (page_extents), which are read off the same rows."""
    page = Window.partitionBy("page_id")
    return words.select("*", F.max(F.col("x") + F.col("w")).over(page).alias("ext_w"), F.max(F.col("y") + F.col("h")).over(page).alias("ext_h"))


def page_extents(words: DataFrame) -> DataFrame:
    return words.groupBy("page_id").agg(F.max(F.col("x") + F.col("w")).alias("ext_w"), F.max(F.col("y") + F.col("h")).alias("ext_h"))


def assemble_lines(words: DataFrame, *keys: str) -> DataFrame:
    """One row a line: text in x order, union box, mean confidence. keys: more columns that part the words (an anchor, a field)."""
    group = ["page_id", *keys, "block_num", "par_num", "line_num"]
    found = words.where(F.trim("text") != "").groupBy(*group).agg(
        F.sort_array(F.collect_list(F.struct("x", "word_no", "text"))).alias("ws"), F.min("x").alias("lx"), F.min("y").alias("ly"),
        (F.max(F.col("x") + F.col("w")) - F.min("x")).alias("lw"), (F.max(F.col("y") + F.col("h")) - F.min("y")).alias("lh"), F.avg("conf").alias("avg_conf"), F.count("*").alias("n_words"),
    )
    return found.select(*group, F.array_join(F.transform("ws", lambda w: w["text"]), " ").alias("text"), F.col("lx").alias("x"), F.col("ly").alias("y"), F.col("lw").alias("w"), F.col("lh").alias("h"), "avg_conf", "n_words")


def line_texts(words: DataFrame) -> DataFrame:
    """page_id, block_num, par_num, line_num and text of the lines of assemble_lines, put together where the pages lie."""
    of = {f.name: f for f in words.schema.fields}
    schema = T.StructType([of[c] for c in ("page_id", "block_num", "par_num", "line_num", "text")])

    def read(rows: pa.Table, starts: np.ndarray, pages: pa.Table) -> pa.RecordBatch:
        page = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        able = pc.fill_null(pc.not_equal(pc.utf8_trim(rows["text"], " "), ""), False)
        rows, page = rows.filter(able), page[able.to_numpy()]
        # Nulls come first in an order, and are equal.
        number = lambda c: (lambda v: np.where(np.isnan(v), -np.inf, v))(rows[c].cast(pa.float64()).to_numpy())
        ids = [number(c) for c in ("block_num", "par_num", "line_num")]
        order = np.lexsort((number("word_no"), number("x"), *ids[::-1], page))
        begins = np.ones(len(order), bool)
        begins[1:] = np.any([c[order][1:] != c[order][:-1] for c in (page, *ids)], 0)
        starts = np.flatnonzero(begins)
        texts = rows["text"].combine_chunks().take(pa.array(order))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(starts, len(order)), pa.int32()), texts), " ")
        first = pa.array(order[starts])
        columns = [rows[c].combine_chunks().take(first) for c in ("page_id", "block_num", "par_num", "line_num")] + [joined]
        return pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return in_pages(words.select("page_id", "word_no", "text", "block_num", "par_num", "line_num", "x"), read, schema)


def page_text(lines: DataFrame) -> DataFrame:
    """A page's lines in reading order, folded to upper ASCII, one a row of text; Cyrillic look-alikes of O and I are read as such."""
    joined = lines.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("y", "x", "line_num", "text"))).alias("ls"))
    return joined.select("page_id", read_text(F.array_join(F.transform("ls", lambda s: s["text"]), "\n")).alias("text"))


def read_text(text: Column) -> Column:
    return F.translate(folded(text), "ОІ", "OI")


@F.arrow_udf(T.StringType())
def joined_lines(ws: pa.Array) -> pa.Array:
    """The lines of pages whose words are arrays (structs of no, text, line and box, in their order): those of assemble_lines in the order of page_text, column by column."""
    number = lambda c: c.to_numpy(zero_copy_only=False)
    real = lambda c: number(c.cast(pa.float64()))
    # Nulls come first in an order, and are no least value of a line.
    first = lambda c: np.where(np.isnan(c), -np.inf, c)
    page = np.repeat(np.arange(len(ws)), number(pc.fill_null(pc.list_value_length(ws), 0)))
    flat = ws.flatten()
    able = pc.fill_null(pc.not_equal(pc.utf8_trim(pc.struct_field(flat, "text"), " "), ""), False)
    flat, page = flat.filter(able), page[number(able)]
    text, x, y, no = (pc.struct_field(flat, c) for c in ("text", "x", "y", "no"))
    ids = [first(real(c)) for c in pc.struct_field(flat, "line").flatten()]
    order = np.lexsort((real(no), first(real(x)), *ids[::-1], page))
    keys = [c[order] for c in (page, *ids)]
    begins = np.ones(len(order), bool)
    begins[1:] = np.any([k[1:] != k[:-1] for k in keys], 0)
    starts = np.flatnonzero(begins)
    group = lambda items, cuts: pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), items)
    lines = pc.binary_join(group(text.take(pa.array(order)), np.append(starts, len(order))), " ")
    least = lambda c: first(np.fmin.reduceat(real(c)[order], starts)) if len(starts) else np.zeros(0)
    keys = (keys[0][starts], least(y), least(x), keys[-1][starts])
    order = np.lexsort(keys[::-1])
    same = np.all([k[order[1:]] == k[order[:-1]] for k in keys], 0)
    if same.any():
        # Lines of several blocks at one place come in the order of their bytes.
        held = lines.to_pylist()
        order = np.array(sorted(order.tolist(), key=lambda k: (*(c[k] for c in keys), held[k].encode("utf-8", "surrogatepass"))))
    return pc.binary_join(group(lines.take(pa.array(order)), np.searchsorted(keys[0][order], np.arange(len(ws) + 1))), "\n")


def page_texts(ws: Column) -> Column:
    """page_text of pages whose words are arrays; '' for a page without words."""
    return read_text(joined_lines(ws))


def page_skew(words: DataFrame) -> DataFrame:
    """Median angle of the segments from the first to the last word's centre of each line, of those within 30 degrees; 0 for none."""
    ends = words.groupBy("page_id", "block_num", "par_num", "line_num").agg(F.min_by(F.struct((F.col("x") + F.col("w") / 2).alias("cx"), (F.col("y") + F.col("h") / 2).alias("cy")), F.struct("x", "word_no")).alias("a"), F.max_by(F.struct((F.col("x") + F.col("w") / 2).alias("cx"), (F.col("y") + F.col("h") / 2).alias("cy")), F.struct("x", "word_no")).alias("b"), F.count("*").alias("n"))
    angle = F.when(F.col("n") > 1, F.degrees(F.atan2(F.col("b.cy") - F.col("a.cy"), F.col("b.cx") - F.col("a.cx"))))
    return ends.select("page_id", F.when(F.abs(angle) <= 30, angle).alias("angle")).groupBy("page_id").agg(F.coalesce(F.percentile("angle", 0.5), F.lit(0.0)).alias("skew_angle_deg"))


def points_box(points: Column) -> Column:
    """x, y, w, h around points: floors of the least, ceilings of the largest, corners not below 0, sides of one or more; NULL without points."""
    xs, ys = F.transform(points, lambda p: F.get(p, 0)), F.transform(points, lambda p: F.get(p, 1))
    low = lambda c: F.floor(F.array_min(c)).cast("int")
    side = lambda c: F.greatest(F.lit(1), F.ceil(F.array_max(c)).cast("int") - F.floor(F.array_min(c)).cast("int"))
    box = F.struct(F.greatest(F.lit(0), low(xs)).alias("x"), F.greatest(F.lit(0), low(ys)).alias("y"), side(xs).alias("w"), side(ys).alias("h"))
    return F.when(F.size(F.array_compact(xs)) > 0, box)


def corners_box(corners: Column) -> Column:
    """The box of x1, y1, x2, y2 in any order."""
    return F.when(F.size(corners) == 4, points_box(F.array(F.slice(corners, 1, 2), F.slice(corners, 3, 2))))


def payload_lines(payloads: DataFrame, min_conf: float = 0.0) -> DataFrame:
    """The lines of recogniser payloads (page_id, result_no, rec_texts, rec_scores, rec_polys, rec_boxes, text_word, text_word_boxes) that have text and confidence, numbered over the page's results.

    Scores up to 1 are percent times 100; a missing one is 0. words: the line's own words with boxes, where both come in equal number; box: the polygon's, else the box's.
    """
    rows = payloads.select("page_id", "result_no", F.posexplode("rec_texts").alias("k", "raw"), "rec_scores", "rec_polys", "rec_boxes", "text_word", "text_word_boxes")
    at = lambda c: F.get(F.col(c), F.col("k"))
    score = F.coalesce(at("rec_scores"), F.lit(0.0))
    paired = F.when(F.size(at("text_word")) == F.size(at("text_word_boxes")), F.zip_with(at("text_word"), at("text_word_boxes"), lambda t, b: F.struct(F.trim(t).alias("text"), corners_box(b).alias("box"))))
    able = F.filter(paired, lambda v: v["text"].isNotNull() & (v["text"] != "") & v["box"].isNotNull())
    lines = rows.select("page_id", "result_no", "k", F.trim("raw").alias("text"), F.when(score <= 1, score * 100).otherwise(score).alias("conf"), able.alias("words"), F.coalesce(points_box(at("rec_polys")), corners_box(at("rec_boxes"))).alias("box"))
    number = F.row_number().over(Window.partitionBy("page_id").orderBy("result_no", "k"))
    return lines.where((F.col("text") != "") & (F.col("conf") >= min_conf)).withColumn("line_no", number)


def payload_to_words(payloads: DataFrame, min_conf: float = 0.0) -> DataFrame:
    """Words of recogniser payloads in the order of their lines: a line's own word boxes where it has any, else its box split by characters; lines without a box give no word."""
    lines = payload_lines(payloads, min_conf)
    parts, placed = line_words()
    # One pass over the lines: those with words of their own have these, the others with a box are split.
    owned = F.size("words") > 0
    told = lines.select("page_id", "line_no", "conf", F.when(owned, F.col("words")).alias("words"), F.when(~F.coalesce(owned, F.lit(False)) & F.rlike("text", F.lit(HAS_WORD)), F.col("text")).alias("text"), "box.*").where("words IS NOT NULL OR x IS NOT NULL AND text IS NOT NULL")
    split = told.withColumn("parts", F.when(F.col("text").isNotNull(), parts))
    cell = lambda v, x, y, w, h: F.struct(v["text"].alias("text"), x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h"))
    mine = F.transform("words", lambda v: cell(v, v["box"]["x"], v["box"]["y"], v["box"]["w"], v["box"]["h"]))
    cut = F.transform(placed, lambda v: cell(v, v["x"], F.col("y"), v["w"], F.col("h")))
    rows = split.select("page_id", F.col("line_no").alias("line_num"), "conf", F.posexplode(F.when(F.col("words").isNotNull(), mine).otherwise(cut)).alias("part", "v")).select("page_id", "line_num", "part", "conf", "v.*")
    order = Window.partitionBy("page_id").orderBy("line_num", "part")
    return rows.select("page_id", (F.row_number().over(order) - 1).alias("word_no"), "text", "conf", "x", "y", "w", "h", F.lit(1).alias("block_num"), F.lit(1).alias("par_num"), "line_num")


def payload_text(payloads: DataFrame) -> DataFrame:
    """page_id and text: the texts of all results that aren't blank, one a line."""
    rows = payloads.select("page_id", "result_no", F.posexplode("rec_texts").alias("k", "raw")).where(F.trim("raw") != "")
    held = rows.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("result_no", "k", F.trim("raw").alias("text")))).alias("ls"))
    return held.select("page_id", F.array_join(F.transform("ls", lambda x: x["text"]), "\n").alias("text"))


def markup_to_text(pages: DataFrame) -> DataFrame:
    """page_id, line_no, text of mark-up: row ends and breaks part lines, other tags are spaces, lines need a letter or digit."""
    text = F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), "\r", "\n"), "(?i)<img[^>]*>", " ")
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "(?i)</(tr|table|td)>", "\n"), "(?i)<br *\\/?>", "\n"), "<[^>]+>", " ")
    lines = F.transform(F.split(text, "\n"), lambda t: F.trim(F.regexp_replace(t, "[ \\t\\f\\x0B]+", " ")))
    kept = F.filter(lines, lambda t: F.rlike(t, F.lit("[A-Za-z0-9ÇĞİÖŞÜçğıöşü]")))
    return pages.select("page_id", F.posexplode(kept).alias("line_no", "text"))
