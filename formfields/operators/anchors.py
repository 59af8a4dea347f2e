"""Labels on pages: search regions, fuzzy phrase matching, overlap probes, merging with template hits."""

from __future__ import annotations

import difflib
import functools
from collections.abc import Callable
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import behind, match_form
from ..scratch import written
from .words import in_pages, page_extents, page_texts, with_extents


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def sequence_ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratios of the strings of two arrays, place by place; equal pairs of a batch are compared once."""
    known: dict[tuple[str, str], float] = {}

    def ratio(x: str, y: str) -> float:
        if x == y:
            return 1.0
        if (x, y) not in known:
            known[x, y] = difflib.SequenceMatcher(None, x, y).ratio()
        return known[x, y]

    return pd.Series([[ratio(p, q) for p, q in zip(x, y, strict=True)] for x, y in zip(a, b, strict=True)])


def center_in(x: str, y: str, w: str, h: str, rx: Column, ry: Column, rw: Column, rh: Column) -> Column:
    cx, cy = F.col(x) + F.col(w) / 2, F.col(y) + F.col(h) / 2
    return cx.between(rx, rx + rw) & cy.between(ry, ry + rh)


def scope_words(words: DataFrame, anchors: DataFrame) -> DataFrame:
    """Each word with each anchor whose search region (in the words' extents) holds the word's centre. The rules are a fixed handful of rows."""
    sized = words.join(page_extents(words), "page_id")
    region = lambda share, whole: (F.col(share) * F.col(whole)).cast("int")
    rx, ry, rw, rh = region("rx", "ext_w"), region("ry", "ext_h"), region("rw", "ext_w"), region("rh", "ext_h")
    met = sized.join(F.broadcast(anchors), F.col("rx").isNull() | center_in("x", "y", "w", "h", rx, ry, F.greatest(rw, F.lit(1)), F.greatest(rh, F.lit(1))))
    return met.select("page_id", "anchor_no", "anchor", "word_no", "text", "conf", "x", "y", "w", "h", "block_num", "par_num", "line_num")


def alias_tokens(anchors: DataFrame) -> DataFrame:
    aliases = anchors.select("anchor_no", "anchor", "min_score", F.posexplode("aliases").alias("alias_no", "alias"))
    split = aliases.withColumn("tokens", F.expr("filter(split(norm, ' '), t -> t <> '')") if "norm" in aliases.columns else F.filter(F.split(match_form(F.col("alias")), " "), lambda t: t != ""))
    return split.withColumn("n_tokens", F.size("tokens")).where("n_tokens > 0")


def levenshtein_share(a: Column, b: Column) -> Column:
    """1 - distance / longer length, for strings whose lengths are near each other; 0 else."""
    la, lb = F.length(a), F.length(b)
    longest = F.greatest(la, lb)
    near = F.abs(la - lb) <= F.when(longest <= 4, 2).otherwise(3)
    return F.when(near, F.greatest(F.lit(0.0), 1 - F.levenshtein(a, b) / longest)).otherwise(F.lit(0.0))


def similarity_bound(a: Column, b: Column) -> Column:
    """No similarity of two strings is higher: only characters that occur in both can match."""
    la, lb = F.length(a), F.length(b)
    left_over = lambda x, y: F.length(F.call_function("translate", x, y, F.lit("")))
    common = F.least(la - left_over(a, b), lb - left_over(b, a))
    return F.greatest(2.0 * common / (la + lb), common / F.greatest(la, lb))


# Tables of similar pairs up to this many rows go to every task; larger ones are joined by their strings.
BROADCAST_PAIRS = 200_000


def similar_pairs(pairs: DataFrame) -> DataFrame:
    """p, q and their similarity: Ratcliff-Obershelp's ratio or the share that Levenshtein leaves, the larger. Each distinct pair (p, q) is compared once, however often a corpus has it."""
    return rated_pairs(pairs).select("p", "q", F.greatest("ratio", levenshtein_share(F.col("p"), F.col("q"))).alias("similarity"))


def rated_pairs(pairs: DataFrame) -> DataFrame:
    """p, q and Ratcliff-Obershelp's ratio of the distinct pairs."""
    once = pairs.select("p", "q").distinct()
    return once.withColumn("ratio", sequence_ratios(F.array("p"), F.array("q"))[0])


def page_rows(words: DataFrame, texts: bool = False) -> DataFrame:
    """page_id, extents, and the words that have a match form as one array in their order: no, norm, line (block, paragraph, line) and box; with texts also the other words, and each word's text."""
    # A word of capitals and digits, as most are, is its own match form.
    norm = F.when(F.rlike("text", F.lit("^[A-Z0-9]+\\z")), F.col("text")).otherwise(match_form(F.col("text")))
    word = F.struct(F.col("word_no").alias("no"), *(["text"] if texts else []), "norm", F.struct("block_num", "par_num", "line_num").alias("line"), "x", "y", "w", "h")
    return words.withColumn("norm", norm).groupBy("page_id").agg(
        F.max(F.col("x") + F.col("w")).alias("ext_w"), F.max(F.col("y") + F.col("h")).alias("ext_h"), F.sort_array(F.collect_list(word if texts else F.when(F.col("norm") != "", word))).alias("ws"),
    )


def scope_rules(anchors: DataFrame) -> DataFrame:
    """The anchors that have aliases (a handful of rows), each with its aliases as an array: alias_no, alias, tokens, and these run together."""
    listed = alias_tokens(anchors).groupBy("anchor_no").agg(F.sort_array(F.collect_list(F.struct("alias_no", "alias", "tokens", F.array_join("tokens", "").alias("joined")))).alias("aliases"))
    return anchors.select("anchor_no", "anchor", "min_score", "rx", "ry", "rw", "rh").join(F.broadcast(listed), "anchor_no")


def label_finder(rules: list[Row], exact: bool = True, max_tokens: int = 4) -> Callable[[pa.Array, pa.Array, pa.Array], list[np.ndarray]]:
    """What finds the labels of a batch of pages: of their words as arrays, and their extents, it gives page, anchor_no, alias_no, box (x, y, w, h) and score of the best phrase of each anchor, by page.

    Of phrases that equal an alias earlier aliases come first, then those met token by token before words run together
    (fewer words first), then the phrase's place. Unless exact, anchors without one have the most similar phrase (near_phrases).
    Batches of pages are compared column by column.
    """
    wanted = [(r, [(a["alias_no"], a["tokens"], a["joined"]) for a in r["aliases"]]) for r in rules]
    pieces = {t for _, aliases in wanted for _, tokens, _ in aliases for t in tokens}
    pieces |= {joined[i:k] for _, aliases in wanted for _, _, joined in aliases for i in range(len(joined)) for k in range(i + 1, len(joined) + 1)}
    known = sorted(pieces)
    code = {t: k for k, t in enumerate(known)}
    found_rules = [(r["anchor_no"], r["min_score"], None if r["rx"] is None else (r["rx"], r["ry"], r["rw"], r["rh"]), aliases) for r, aliases in wanted]

    def labels(ws: pa.Array, ext_w: pa.Array, ext_h: pa.Array) -> list[np.ndarray]:
        flat = ws.flatten()
        part = lambda rows, c: pc.struct_field(rows, c)
        number = lambda c: c.to_numpy(zero_copy_only=False)
        page = np.repeat(np.arange(len(ws)), number(pc.fill_null(pc.list_value_length(ws), 0)))
        able = number(pc.fill_null(pc.not_equal(part(flat, "norm"), ""), False))
        if not able.all():
            flat, page = flat.filter(pa.array(able)), page[able]
        x, y, w, h = (number(part(flat, c)) for c in "xywh")
        lines = [number(c) for c in part(flat, "line").flatten()]
        # Words that are no piece of an alias have the code -1, and so the last cell of the tables below.
        codes = number(pc.fill_null(pc.index_in(part(flat, "norm"), value_set=pa.array(known, pa.string())), -1))
        size = np.array([*map(len, known), 0])
        out = []
        for anchor_no, min_score, region, aliases in found_rules:
            scope = np.arange(len(page))
            if region is not None:
                low = lambda share, whole: np.trunc(share * number(whole))[page]
                left, top = low(region[0], ext_w), low(region[1], ext_h)
                wide, high = np.maximum(1, low(region[2], ext_w)), np.maximum(1, low(region[3], ext_h))
                cx, cy = x + w / 2, y + h / 2
                scope = np.flatnonzero((cx >= left) & (cx <= left + wide) & (cy >= top) & (cy <= top + high))
            c = codes[scope]
            follows = np.zeros(len(scope), bool)
            follows[:-1] = page[scope[1:]] == page[scope[:-1]]
            for ids in lines:
                follows[:-1] &= ids[scope[1:]] == ids[scope[:-1]]
            open_pages = np.ones(len(ws), bool)

            def add(scope: np.ndarray, at: np.ndarray, n: np.ndarray, alias_no: np.ndarray, score: np.ndarray) -> None:
                """Labels of n words from the places `at` of the scope on."""
                cells = [scope[np.minimum(at + np.minimum(k, n - 1), len(scope) - 1)] for k in range(int(n.max(initial=1)))]
                bx, by = np.min([x[k] for k in cells], 0), np.min([y[k] for k in cells], 0)
                bw, bh = np.max([x[k] + w[k] for k in cells], 0) - bx, np.max([y[k] + h[k] for k in cells], 0) - by
                out.append((page[scope[at]], np.full(len(at), anchor_no), alias_no, bx, by, bw, bh, score))

            def keep(alias_no: int, at: np.ndarray, n: int) -> None:
                """Phrases of n words from the places `at` on: the first of each page that has none yet."""
                at = at[open_pages[page[scope[at]]]]
                pages_of = page[scope[at]]
                at = at[np.r_[True, pages_of[1:] != pages_of[:-1]]] if len(at) else at
                open_pages[page[scope[at]]] = False
                add(scope, at, np.full(len(at), n), np.full(len(at), alias_no), np.ones(len(at)))

            def runs(at: np.ndarray, n: int) -> np.ndarray:
                """Of places in the scope those with n words in a row on one line."""
                at = at[at + n <= len(scope)]
                for k in range(n - 1):
                    at = at[follows[at + k]]
                return at

            for alias_no, tokens, joined in aliases:
                if len(tokens) <= max_tokens:
                    at = runs(np.flatnonzero(c == code[tokens[0]]), len(tokens))
                    for k, t in enumerate(tokens):
                        at = at[c[at + k] == code[t]]
                    keep(alias_no, at, len(tokens))
                if len(tokens) > 1:
                    # The code of the joined alias from one place to another, by both places.
                    between = np.full((len(joined) + 2, len(joined) + 2), -2)
                    for i in range(len(joined)):
                        for k in range(i + 1, len(joined) + 1):
                            between[i, k] = code[joined[i:k]]
                    starts = np.zeros(len(known) + 1, bool)
                    starts[[code[joined[:k]] for k in range(1, len(joined) + 1)]] = True
                    begun = np.flatnonzero(starts[c])
                    for n in (1, 2, 3):
                        at = runs(begun, n)
                        end = np.zeros(len(at), np.int64)
                        for k in range(n):
                            then = np.minimum(end + size[c[at + k]], len(joined) + 1)
                            fits = c[at + k] == between[end, then]
                            at, end = at[fits], then[fits]
                        keep(alias_no, at[end == len(joined)], n)
            rest = np.flatnonzero(open_pages[page[scope]])
            if not exact and len(rest):
                scope, follows = scope[rest], follows[rest]
                add(scope, *near_phrases(part(flat, "norm").take(pa.array(scope)), page[scope], follows, aliases, min_score, max_tokens))
        columns = [np.concatenate(cells) for cells in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 7 + [np.zeros(0)]
        order = np.argsort(columns[0], kind="stable")
        return [cells[order] for cells in columns]

    return labels


# Similarities of pairs that a Python worker keeps.
KNOWN_PAIRS = 200_000


def character_counts(texts: list[str]) -> np.ndarray:
    """How often each ASCII character is in each text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    chars = np.frombuffer("".join(texts).encode("ascii"), np.uint8)
    return np.bincount(np.repeat(np.arange(len(texts)), sizes) * 128 + chars, minlength=128 * len(texts)).reshape(-1, 128)


def highest_similarity(counts: np.ndarray, token: str) -> np.ndarray:
    """No similarity of texts (character_counts) with a token is higher: only characters that occur in both can match."""
    own = character_counts([token])[0]
    sizes = counts.sum(1)
    common = np.minimum(counts @ (own > 0), (counts > 0) @ own)
    return np.maximum(2.0 * common / (sizes + len(token)), common / np.maximum(sizes, len(token)))


def edits(a: str, b: str) -> int:
    """Levenshtein's distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for k, y in enumerate(b, 1):
            before, row[k] = row[k], min(row[k] + 1, row[k - 1] + 1, before + (x != y))
    return row[-1]


@functools.lru_cache(KNOWN_PAIRS)
def similarity(p: str, q: str) -> float:
    """What similar_pairs says of a pair."""
    if p == q:
        return 1.0
    longest = max(len(p), len(q))
    share = max(0.0, 1 - edits(p, q) / longest) if abs(len(p) - len(q)) <= (2 if longest <= 4 else 3) else 0.0
    return max(difflib.SequenceMatcher(None, p, q).ratio(), share)


def near_phrases(norms: pa.Array, page: np.ndarray, follows: np.ndarray, aliases: list[tuple], min_score: float, max_tokens: int) -> tuple[np.ndarray, ...]:
    """Of the words of a search region (their match forms, pages, and whether the next one follows on the line) the place, number of words, alias_no and score of the best phrase of each page that reaches min_score.

    Scores are the mean similarity of tokens, or that of one to three words run together with the alias without its blanks,
    where their lengths differ by two at most. Among equals the order is that of equal phrases.
    """
    coded = norms.dictionary_encode()
    word = coded.indices.to_numpy(zero_copy_only=False)
    texts = coded.dictionary.to_pylist()
    counts = character_counts(texts)
    size = np.array([len(t) for t in texts], np.int64)
    bounds = {t: highest_similarity(counts, t) for _, tokens, _ in aliases for t in tokens}
    places = {1: np.arange(len(word))}
    for n in range(2, max(max_tokens, 3) + 1):
        at = places[n - 1]
        at = at[at + n <= len(word)]
        places[n] = at[follows[at + n - 2]]
    least = min_score - 1e-9
    found = []
    for alias_no, tokens, joined in aliases:
        n = len(tokens)
        if n <= max_tokens:
            at = places[n]
            at = at[sum(bounds[t][word[at + k]] for k, t in enumerate(tokens)) / n >= least]
            score = sum((np.array([similarity(texts[v], t) for v in word[at + k]], float) for k, t in enumerate(tokens)), np.zeros(len(at))) / n
            found.append((page[at], -score, np.full(len(at), alias_no), np.zeros(len(at), int), np.zeros(len(at), int), at, np.full(len(at), n)))
        for m in (1, 2, 3) if n > 1 else ():
            at = places[m]
            at = at[abs(sum(size[word[at + k]] for k in range(m)) - len(joined)) <= 2]
            at = at[highest_similarity(sum(counts[word[at + k]] for k in range(m)), joined) >= least]
            score = np.array([similarity("".join(texts[v] for v in word[a : a + m]), joined) for a in at], float)
            found.append((page[at], -score, np.full(len(at), alias_no), np.ones(len(at), int), np.full(len(at), m), at, np.full(len(at), m)))
    columns = [np.concatenate(cells) for cells in zip(*found, strict=True)]
    columns = [c[-columns[1] >= min_score] for c in columns]
    columns = [c[np.lexsort(columns[::-1])] for c in columns]
    first = np.ones(len(columns[0]), bool)
    first[1:] = columns[0][1:] != columns[0][:-1]
    _, lost, alias_no, _, _, at, n = (c[first] for c in columns)
    return at, n, alias_no, -lost


def exact_labels(pages: DataFrame, words: DataFrame, rules: list[Row], max_tokens: int = 4) -> DataFrame:
    """pages (what page_rows makes of words) with `labels`: anchor_no, alias_no and box of the first phrase on a page that equals an alias, for the anchors that have one (label_finder)."""
    find = label_finder(rules, True, max_tokens)
    kinds = {c: words.schema[c].dataType.simpleString() for c in "xywh"}

    @F.arrow_udf(f"array<struct<anchor_no:int,alias_no:int,box:struct<{','.join(f'{c}:{k}' for c, k in kinds.items())}>>>")
    def labels(ws: pa.Array, ext_w: pa.Array, ext_h: pa.Array) -> pa.Array:
        columns = find(ws, ext_w, ext_h)
        box = pa.StructArray.from_arrays([pa.array(cells, from_pandas=True).cast(pc.struct_field(ws.flatten(), n).type) for n, cells in zip("xywh", columns[3:7], strict=True)], names=list("xywh"))
        held = pa.StructArray.from_arrays([pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()), box], names=["anchor_no", "alias_no", "box"])
        ends = np.searchsorted(columns[0], np.arange(len(ws) + 1))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), held)

    return pages.withColumn("labels", labels("ws", "ext_w", "ext_h"))


def label_words(words: DataFrame, *more: str) -> DataFrame:
    """The words as label_finder reads them: place, line, box and match form; with more of their columns."""
    # A word of capitals and digits, as most are, is its own match form.
    norm = F.when(F.rlike("text", F.lit("^[A-Z0-9]+\\z")), F.col("text")).otherwise(match_form(F.col("text")))
    return words.select("page_id", "word_no", norm.alias("norm"), "block_num", "par_num", "line_num", "x", "y", "w", "h", *more)


def page_arrays(rows: pa.Table, starts: np.ndarray, *more: str) -> tuple[pa.Array, pa.Array, pa.Array]:
    """The words of in_pages as an array for each page, and the pages' extents."""
    cell = lambda c: one_chunk(rows[c])
    line = pa.StructArray.from_arrays([cell(c) for c in ("block_num", "par_num", "line_num")], names=["block_num", "par_num", "line_num"])
    names = ["norm", "x", "y", "w", "h", *more]
    words = pa.StructArray.from_arrays([cell("word_no"), line, *map(cell, names)], names=["no", "line", *names])
    far = [pc.add(cell(c), cell(size)).cast(pa.float64()).to_numpy(zero_copy_only=False) for c, size in ("xw", "yh")]
    # A page without words has no extents, and takes no part.
    able = np.flatnonzero(np.diff(starts))
    ends = [np.zeros(len(starts) - 1), np.zeros(len(starts) - 1)]
    for c, e in zip(far, ends, strict=True):
        if len(able):
            e[able] = np.fmax.reduceat(c, starts[able])
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), words), *map(pa.array, ends)


def labelled_texts(words: DataFrame, anchors: DataFrame) -> DataFrame:
    """page_id, text (page_text) and found, the names of the anchors with a label that equals an alias, of every page; its words are put together once for both."""
    known = scope_rules(anchors).collect()
    names = F.create_map(*[F.lit(v) for r in known for v in (r["anchor_no"], r["anchor"])])
    pages = exact_labels(page_rows(words, texts=True), words, known).withColumn("text", page_texts(F.col("ws")))
    return pages.select("page_id", "text", F.transform("labels", lambda l: names[l["anchor_no"]]).alias("found"))


def match_anchors(words: DataFrame, anchors: DataFrame, exact: bool = False, max_tokens: int = 4) -> DataFrame:
    """page_id, anchor, alias, score and box of the best phrase of each anchor on each page.

    A phrase is n words in a row on one line, or one to three words run together that match the alias without its
    blanks. Scores are the mean similarity of tokens (similar_pairs); where a phrase of a page equals an alias of an anchor, no
    other can be better. Whole pages are looked at where they lie, with one pass over the words. exact: equality only.
    """
    known = scope_rules(anchors).collect()
    find = label_finder(known, exact, max_tokens)
    names = {r["anchor_no"]: r["anchor"] for r in known}
    aliases = {(r["anchor_no"], a["alias_no"]): a["alias"] for r in known for a in r["aliases"]}
    kind = {f.name: f for f in words.schema.fields}
    schema = T.StructType([kind["page_id"], T.StructField("anchor", T.StringType()), T.StructField("alias", T.StringType()), T.StructField("score", T.DoubleType()), *[T.StructField(f"a{c}", kind[c].dataType) for c in "xywh"]])

    def read(rows: pa.Table, starts: np.ndarray, _pages: pa.Table) -> pa.RecordBatch:
        page, anchor, alias, *box, score = find(*page_arrays(rows, starts))
        of = lambda values: pa.array(values, pa.string())
        columns = [rows["page_id"].take(pa.array(starts[page])), of([names[a] for a in anchor.tolist()]), of([aliases[k] for k in zip(anchor.tolist(), alias.tolist(), strict=True)]), pa.array(score, pa.float64())]
        columns += [pa.array(cells, from_pandas=True).cast(rows.schema.field(c).type) for c, cells in zip("xywh", box, strict=True)]
        return one_batch(columns, [f.name for f in schema.fields])

    return in_pages(label_words(words), read, schema)


def one_chunk(cells: pa.Array | pa.ChunkedArray) -> pa.Array:
    return cells.combine_chunks() if isinstance(cells, pa.ChunkedArray) else cells


def one_batch(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*map(one_chunk, columns)], names=names)


def alias_overlap_probe(words: DataFrame, anchors: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines that hold tokens of an anchor's aliases: how many alias tokens (repeats count) the line has."""
    tokens = lines.select("page_id", "line_num", "x", "y", F.explode(F.array_distinct(F.split(match_form(F.col("text")), " "))).alias("token")).where("token <> ''")
    wanted = alias_tokens(anchors).select("anchor", F.explode("tokens").alias("token")).groupBy("anchor", "token").agg(F.count("*").alias("times"))
    return tokens.join(F.broadcast(wanted), "token").groupBy("page_id", "anchor", "line_num").agg(F.sum("times").alias("token_overlap"), F.min("x").alias("x"), F.min("y").alias("y"))


def merge_anchors(found: DataFrame, hits: DataFrame, least: float = 0.62, own_least: dict[str, float] | None = None) -> DataFrame:
    """Text anchors, and the best template hit of anchors that text has not found (page_id, anchor, template_file, score, x, y, w, h).

    own_least: other thresholds than `least`, by anchor. Of hits with one score the first by file name, then by place, counts.
    """
    bound = F.lit(least)
    for anchor, own in (own_least or {}).items():
        bound = F.when(F.col("anchor") == anchor, own).otherwise(bound)
    order = F.struct(-F.col("score"), "template_file", "y", "x", "w", "h")
    best = hits.where(F.col("score") >= bound).groupBy("page_id", "anchor").agg(F.min_by(F.struct("template_file", "score", "x", "y", "w", "h"), order).alias("b"))
    more = best.join(found, ["page_id", "anchor"], "left_anti").select("page_id", "anchor", F.concat(F.lit("[template:"), "b.template_file", F.lit("]")).alias("alias"), F.col("b.score").alias("score"), F.col("b.x").alias("ax"), F.col("b.y").alias("ay"), F.col("b.w").alias("aw"), F.col("b.h").alias("ah"))
    return found.unionByName(more)


def anchor_coverage(found: DataFrame, anchors: DataFrame, pages: DataFrame) -> DataFrame:
    """Of each anchor: pages on which it was found, pages in all, and their ratio."""
    hits = found.groupBy("anchor").agg(F.count("*").alias("n_found"))
    total = pages.agg(F.count("*").alias("n_pages"))
    return anchors.select("anchor").join(hits, "anchor", "left").crossJoin(F.broadcast(total)).select("anchor", F.coalesce("n_found", F.lit(0)).alias("n_found"), "n_pages", (F.coalesce("n_found", F.lit(0)) / F.greatest("n_pages", F.lit(1))).alias("hit_rate"))


def page_coverage(found: DataFrame, anchors: DataFrame, pages: DataFrame) -> DataFrame:
    """Of each page: anchors found, and anchors defined."""
    hits = found.groupBy("page_id").agg(F.countDistinct("anchor").alias("n_found"))
    defined = anchors.agg(F.count("*").alias("n_defined"))
    return pages.select("page_id").join(hits, "page_id", "left").crossJoin(F.broadcast(defined)).select("page_id", F.coalesce("n_found", F.lit(0)).alias("n_found"), "n_defined")


def anchor_debug(words: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every word in an anchor's search region with the alias whose tokens it is most like (the first among equals), and whether that would do.

    Ratios are Ratcliff-Obershelp's alone; the search region is given in pixels of the words' extents.
    """
    sized = with_extents(words)
    region = lambda share, whole, none: F.coalesce((F.col(share) * F.col(whole)).cast("int"), none)
    boxed = sized.crossJoin(F.broadcast(anchors.select("anchor_no", "anchor", "min_score", "rx", "ry", "rw", "rh"))).select(
        *words.columns, "anchor_no", "anchor", "min_score", region("rx", "ext_w", F.lit(0)).alias("region_x"), region("ry", "ext_h", F.lit(0)).alias("region_y"),
        F.greatest(F.lit(1), region("rw", "ext_w", F.col("ext_w"))).alias("region_w"), F.greatest(F.lit(1), region("rh", "ext_h", F.col("ext_h"))).alias("region_h"),
    ).where(center_in("x", "y", "w", "h", F.col("region_x"), F.col("region_y"), F.col("region_w"), F.col("region_h")))
    # A ratio sees of a word only the characters that some token has; all others are one here, so that words which differ in
    # their digits alone are compared once. The best alias of a form and an anchor is looked up, not found again for each word.
    tokens = anchors.select("anchor_no", F.posexplode("aliases").alias("alias_no", "alias")).select("*", F.posexplode(F.filter(F.split(match_form(F.col("alias")), " "), lambda t: t != "")).alias("token_no", "q"))
    letters = {c for r in tokens.select("q").distinct().collect() for c in r["q"]}  # the rules' own, at most 36
    form = lambda c: F.regexp_replace(c, f"[^{''.join(sorted(letters))}]", "_") if letters else F.repeat(F.lit("_"), F.length(c))
    normed = behind(behind(boxed, word_norm=match_form(F.col("text"))), form=form(F.col("word_norm")))
    forms = written(words.select(form(match_form(F.col("text"))).alias("p")).where("p <> ''").distinct(), "forms")
    able = forms.join(F.broadcast(tokens.select("q").distinct())).where(similarity_bound(F.col("p"), F.col("q")) > 0)
    rated = rated_pairs(able).withColumnRenamed("p", "form").join(F.broadcast(tokens), "q")
    first = F.min(F.struct((-F.col("ratio")).alias("lost"), "alias_no", "token_no", "alias")).alias("b")
    best = rated.where("ratio > 0").groupBy("form", "anchor_no").agg(first).select("form", "anchor_no", F.struct(F.col("b.alias").alias("alias"), (-F.col("b.lost")).alias("score")).alias("best"))
    known = written(best, "best-aliases")
    met = normed.join(F.broadcast(known) if known.count() <= BROADCAST_PAIRS else known, ["form", "anchor_no"], "left")
    out = met.withColumn("best", F.coalesce("best", F.struct(F.lit("").alias("alias"), F.lit(0.0).alias("score"))))
    return out.select(
        "page_id", "anchor", F.col("text").alias("word_text"), "word_norm", F.round("conf", 2).alias("word_conf"), "block_num", "par_num", "line_num",
        F.col("x").alias("word_x"), F.col("y").alias("word_y"), F.col("w").alias("word_w"), F.col("h").alias("word_h"), F.round(F.col("x") + F.col("w") / 2, 2).alias("word_center_x"), F.round(F.col("y") + F.col("h") / 2, 2).alias("word_center_y"),
        "region_x", "region_y", "region_w", "region_h", F.round("min_score", 4).alias("anchor_min_score"), F.col("best.alias").alias("best_alias"), F.round("best.score", 4).alias("best_alias_token_score"), (F.col("best.score") >= F.col("min_score")).cast("int").alias("best_alias_pass"),
    )


# Words that mark an anchor's label on a page, for the collection of exemplars.
LABEL_KEYWORDS = {
    "plate_label": ["PLAKA"], "brand_label": ["MARKASI", "MARKA"], "type_label": ["TIPI", "TIP"], "model_year_label": ["MODEL", "YILI"], "engine_no_label": ["MOTOR", "NO"], "chassis_no_label": ["SASE", "SASE NO", "ŞASE"], "tax_no_label": ["VERGI", "NO"],
    "surname_label": ["SOYADI"], "name_label": ["ADI"], "first_registration_label": ["ILK", "TESCIL"], "registration_label": ["TESCIL", "TARIHI"], "inspection_label": ["MUAYENE", "DIGER"], "serial_label": ["BELGE", "SERI"],
}
PADDING, LEAST_SIDE = 4, 5


def scale_boxes(words: DataFrame, images: DataFrame) -> DataFrame:
    """words with their boxes in the image's pixels (sx, sy, sw, sh) and the padded, clipped box around (x1, y1, x2, y2). images: page_id, image_w, image_h."""
    met = with_extents(words).join(images, "page_id")
    at = lambda c, image, whole: (F.col(c) * F.col(image) / F.col(whole)).cast("int")
    scaled = met.select("*", at("x", "image_w", "ext_w").alias("sx"), at("y", "image_h", "ext_h").alias("sy"), at("w", "image_w", "ext_w").alias("sw"), at("h", "image_h", "ext_h").alias("sh")).drop("ext_w", "ext_h")
    return scaled.select(
        "*", F.greatest(F.lit(0), F.col("sx") - PADDING).alias("x1"), F.greatest(F.lit(0), F.col("sy") - PADDING).alias("y1"),
        F.least("image_w", F.col("sx") + F.col("sw") + PADDING).alias("x2"), F.least("image_h", F.col("sy") + F.col("sh") + PADDING).alias("y2"),
    )


def exemplars(words: DataFrame, images: DataFrame, min_conf: float = 55.0, most: int = 5) -> DataFrame:
    """The first `most` words of each anchor's keywords over the corpus (by page, then word), sure and large enough: anchor, page_id, word_no and the padded box.

    Each partition keeps its own first ones before they meet, so no anchor's words gather in one task.
    """
    text = F.upper(F.trim("text"))
    among = lambda keys: functools.reduce(or_, [F.contains(text, F.lit(k)) for k in keys])
    named = F.array_compact(F.array(*[F.when(among(keys), F.lit(a)) for a, keys in LABEL_KEYWORDS.items()]))
    told = scale_boxes(words.where(F.col("conf") >= min_conf), images).where(f"sw >= {LEAST_SIDE} AND sh >= {LEAST_SIDE}").where(among(sorted({k for keys in LABEL_KEYWORDS.values() for k in keys})))
    place = ["page_id", "word_no", "x1", "y1", "x2", "y2"]
    found = told.select(*place, F.explode(named).alias("anchor"), F.pmod(F.xxhash64("page_id"), F.lit(64)).alias("salt"))
    # A limit by rank is met in each task before rows are shuffled.
    for own in (["anchor", "salt"], ["anchor"]):
        found = found.withColumn("rn", F.row_number().over(Window.partitionBy(*own).orderBy(*place))).where(F.col("rn") <= most).drop("rn")
    return found.select("anchor", *place)


def exemplar_report(found: DataFrame, anchors: DataFrame) -> DataFrame:
    """Exemplars of each anchor, also of those without any, and whether they are enough (three), some or none."""
    counts = found.groupBy("anchor").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return anchors.select("anchor").join(counts, "anchor", "left").select("anchor", n.alias("n"), F.when(n >= 3, "enough").when(n > 0, "some").otherwise("none").alias("grade"))
