"""Candidates of a whole page at once: a page is one row with its words as an array, and regions, lines and plates are found in it.

Nothing is joined word by word and nothing is shuffled but the words of a page, once. The same candidates row by row are in
`fields` and `candidates`; both forms give the same rows.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.filters import TYPE_BLOCK
from ..functions.text import FOLD_FROM, FOLD_TO, LABEL_WORDS, PLATE, behind, collapsed, folded
from .anchors import label_finder, label_words, one_batch, page_arrays, scope_rules
from .anchors import one_chunk as whole
from .candidates import SERIALS
from .fields import TYPE_TAIL, clipped
from .words import in_pages

BOX = "struct<x:int,y:int,w:int,h:int>"
REGION_FIELDS = ("owner_name", "owner_surname", "type", "serial_no")


WORD = ["no", "text", "conf", "line", "x", "y", "w", "h"]


def page_table(words: DataFrame, pages: DataFrame, anchors: DataFrame) -> DataFrame:
    """page_id, doc_w, doc_h, ws (the page's words in their order) and labels (the boxes of its anchors by name)."""
    found = anchors.groupBy("page_id").agg(F.map_from_entries(F.collect_list(F.struct("anchor", F.struct("ax", "ay", "aw", "ah")))).alias("labels"))
    known = pages.select("page_id", "doc_w", "doc_h").join(found, "page_id", "left")
    of = {f.name: f for f in words.schema.fields}
    line = T.StructType([of[c] for c in ("block_num", "par_num", "line_num")])
    word = T.StructType([T.StructField("no", of["word_no"].dataType), of["text"], of["conf"], T.StructField("line", line), *[of[c] for c in "xywh"]])
    schema = T.StructType([*[known.schema[c] for c in ("page_id", "doc_w", "doc_h")], T.StructField("ws", T.ArrayType(word)), known.schema["labels"]])

    def read(rows: pa.Table, starts: np.ndarray, about: pa.Table) -> pa.RecordBatch:
        return one_batch([*[about[c] for c in ("page_id", "doc_w", "doc_h")], word_arrays(rows, starts), about["labels"]], [f.name for f in schema.fields])

    return in_pages(words.select("page_id", "word_no", "text", "conf", "block_num", "par_num", "line_num", *"xywh"), read, schema, known)


def word_arrays(rows: pa.Table, starts: np.ndarray) -> pa.Array:
    """The words of in_pages as an array for each page, null for pages without any."""
    line = pa.StructArray.from_arrays([whole(rows[c]) for c in ("block_num", "par_num", "line_num")], names=["block_num", "par_num", "line_num"])
    cells = pa.StructArray.from_arrays([line if c == "line" else whole(rows["word_no" if c == "no" else c]) for c in WORD], names=WORD)
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), cells, mask=pa.array(np.diff(starts) == 0))


def found_regions(words: DataFrame, pages: DataFrame, anchors: DataFrame, rules: DataFrame, *wanted: str, exact: bool = False) -> DataFrame:
    """region_table of pages whose labels (of the anchor rules; exact: those that equal an alias) are found in the same pass over their words; wanted: the readings of words that are made (default: all), and only rows that have one of those."""
    known, listed = rules.collect(), scope_rules(anchors).collect()
    find = label_finder(listed, exact)
    names = np.array([r["anchor"] for r in listed], object)
    number = {r["anchor_no"]: k for k, r in enumerate(listed)}
    kinds = {f.name: f for f in words.schema.fields}
    regions = T._parse_datatype_string(region_type(lambda c: kinds[c].dataType.simpleString()))
    schema = T.StructType([pages.schema[c] for c in ("page_id", "doc_w", "doc_h")] + regions.fields)

    def read(rows: pa.Table, starts: np.ndarray, about: pa.Table) -> pa.RecordBatch:
        page, anchor, _, *box, _ = find(*page_arrays(rows, starts))
        items = pa.StructArray.from_arrays([pa.array(c, from_pandas=True).cast(rows.schema.field(n).type) for n, c in zip("xywh", box, strict=True)], names=["ax", "ay", "aw", "ah"])
        keys = pa.array(names[[number[a] for a in anchor.tolist()]].tolist(), pa.string())
        labels = pa.MapArray.from_arrays(pa.array(np.searchsorted(page, np.arange(len(starts))), pa.int32()), keys, items)
        held = page_regions(known, word_arrays(rows, starts), labels, whole(about["doc_w"]), whole(about["doc_h"]), wanted).flatten()
        of = pa.array(np.repeat(np.arange(len(starts) - 1), len(known)))
        columns = [*[whole(about[c]).take(of) for c in ("page_id", "doc_w", "doc_h")], *held.flatten()]
        made = pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])
        return made.filter(functools.reduce(pc.or_, [made.column(c).is_valid() for c in wanted])) if wanted else made

    found = in_pages(label_words(words, "text", "conf"), read, schema, pages.select("page_id", "doc_w", "doc_h"))
    return found.join(F.broadcast(numbered(rules, known)), "rule_no").drop("rule_no")


def table_words(table: DataFrame) -> DataFrame:
    """The words of a page table as rows again."""
    rows = table.select("page_id", F.explode("ws").alias("v"))
    return rows.select("page_id", F.col("v.no").alias("word_no"), "v.text", "v.conf", "v.x", "v.y", "v.w", "v.h", "v.line.*")


def as_box(cells: tuple[Column, Column, Column, Column]) -> Column:
    return F.struct(*[c.cast("int").alias(n) for c, n in zip(cells, "xywh", strict=True)])


def line_quality(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """`quality` of the texts of a batch, and how many letters and digits each has."""
    upper = pa.array([t.upper() for t in texts.to_pylist()], pa.string())
    count = lambda c, pattern: pc.count_substring_regex(c, pattern).to_numpy(zero_copy_only=False)
    tokens = pc.split_pattern(pc.replace_substring_regex(upper, "[^A-Z0-9]+", " "), " ")
    lengths = pc.utf8_length(tokens.flatten()).to_numpy(zero_copy_only=False)
    longest = np.maximum.reduceat(lengths, tokens.offsets.to_numpy()[:-1]) if len(texts) else lengths
    mixed = pc.match_substring_regex(upper, "[A-Z][0-9]|[0-9][A-Z]").to_numpy(zero_copy_only=False)
    capitals = count(upper, "[A-Z]")
    digits = count(texts, "[0-9]")
    return longest + 5 * mixed + np.minimum(capitals, 8) // 3 + np.minimum(digits, 8) // 3, capitals + count(upper, "[0-9]")


def fitted(box: Column) -> Column:
    """A box moved into the page."""
    return as_box(clipped(box["x"], box["y"], box["w"], box["h"], F.col("doc_w"), F.col("doc_h")))


FOLDED = str.maketrans(FOLD_FROM, FOLD_TO)
NO_TYPES = {*TYPE_BLOCK, *LABEL_WORDS}


def tokens_of(text: str, pattern: re.Pattern) -> list[str]:
    """The matches of a pattern in the folded text."""
    return pattern.findall(text if text.isascii() and text.isupper() else text.translate(FOLDED).upper())


def plate_runs(texts: list[str | None], lines: np.ndarray) -> list[tuple[int, int, int, int, str]]:
    """The plates among one to four tokens in a row on a line of words: the first and the last word, the token's number in the first, how many tokens, and the plate."""
    plate, run = re.compile(PLATE), re.compile("[A-Z0-9]+")
    tokens, word, number = [], [], []
    for k, text in enumerate(texts):
        for i, t in enumerate(tokens_of(text, run) if text else ()):
            tokens.append(t)
            word.append(k)
            number.append(i)
    line = lines[word].tolist() if word else []
    found = []
    for k, t in enumerate(tokens):
        # A plate begins with a digit and has nine characters at most.
        raw = "" if t[0] <= "9" else None
        for n in range(1, 5):
            at = k + n - 1
            if raw is None or at >= len(tokens) or line[at] != line[k] or len(raw) + len(tokens[at]) > 9:
                break
            raw += tokens[at]
            if plate.match(raw):
                found.append((word[k], word[at], number[k], n, raw))
    return found


CELL = "struct<method:string,raw:string,priority:int,cand_no:int,bonus:int,plate_score:int,value_box:" + BOX + ">"


def region_type(kind: Callable[[str], str]) -> str:
    """The type of what page_regions says of a page and rule; kind: the types of words' columns."""
    line = f"struct<text:string,{','.join(f'{c}:{kind(c)}' for c in 'xywh')}>"
    return f"struct<rule_no:int,ax:int,ay:int,aw:int,ah:int,roi:{BOX},window:{BOX},beside:{line},within:{line},inside:{line},kind:{line},plate:struct<text:string,score:int,x:int,y:int,w:int,h:int>>"


def numbered(rules: DataFrame, known: list[Row]) -> DataFrame:
    return rules.sparkSession.createDataFrame([(*r, k) for k, r in enumerate(known)], T.StructType([*rules.schema.fields, T.StructField("rule_no", T.IntegerType())]))


def region_table(table: DataFrame, rules: DataFrame) -> DataFrame:
    """A row for each page and rule with `roi`, the box of the rule's region, and `window`, where the value of a label that was found is looked for; null where there is none.

    What its words say comes with it: beside, the best plausible line of the words whose centres lie in the window, by its
    direction (those in front of the label's end before others), within, the line nearest to the region's middle height, inside
    (the words with all edges in the region, in reading order, for fields that read it whole), kind (of these the first token that may be a vehicle's type) and plate (the best plate of the page by its distance from the region).
    Batches of pages meet the rules, a handful, column by column, so a page's words are never copied for each rule.
    """
    known = rules.collect()
    word = table.schema["ws"].dataType.elementType
    region = region_type(lambda c: word[c].dataType.simpleString())

    @F.arrow_udf(f"array<{region}>")
    def regions(ws: pa.Array, labels: pa.Array, doc_w: pa.Array, doc_h: pa.Array) -> pa.Array:
        return page_regions(known, ws, labels, doc_w, doc_h)

    kept = [c for c in table.columns if c not in ("ws", "labels")]
    every = table.select(*kept, F.explode(regions("ws", "labels", "doc_w", "doc_h")).alias("r")).select(*kept, "r.*")
    return every.join(F.broadcast(numbered(rules, known)), "rule_no").drop("rule_no")


def page_regions(rules: list[Row], ws: pa.Array, labels: pa.Array, doc_w: pa.Array, doc_h: pa.Array, wanted: tuple[str, ...] = ()) -> pa.Array:
    """What region_table says of a batch of pages: a list for each page, a struct for each rule. NaN stands for null on the way.

    wanted: the readings of words that are made (default: all); of inside alone, for all fields.
    """
    n_pages, n_rules = len(ws), len(rules)
    number = lambda c: c.to_numpy(zero_copy_only=False)
    real = lambda c: number(c.cast(pa.float64()))
    sizes = number(pc.fill_null(pc.list_value_length(ws), 0))
    page = np.repeat(np.arange(n_pages), sizes)
    flat = ws.flatten()
    text, line = pc.struct_field(flat, "text"), pc.struct_field(flat, "line")
    x, y, w, h, conf, no = (real(pc.struct_field(flat, c)) for c in ("x", "y", "w", "h", "conf", "no"))
    ids = [number(pc.fill_null(pc.struct_field(line, c), -1)) for c in ("block_num", "par_num", "line_num")]
    cx, cy, able = x + w / 2, y + h / 2, number(pc.fill_null(pc.not_equal(pc.utf8_trim(text, " "), ""), False))
    width, height = real(doc_w), real(doc_h)
    # Like greatest and least, fmax and fmin pass over nulls.
    clip = lambda bx, by, bw, bh: (lambda cx, cy: (cx, cy, np.fmax(1, np.fmin(bw, width - cx)), np.fmax(1, np.fmin(bh, height - cy))))(np.fmax(0, np.fmin(bx, width - 1)), np.fmax(0, np.fmin(by, height - 1)))
    label_page = np.repeat(np.arange(n_pages), number(pc.fill_null(pc.list_value_length(labels.cast(pa.list_(pa.struct([("key", pa.string()), ("value", labels.type.item_type)])))), 0)))
    label_box = [real(pc.struct_field(labels.items, c)) for c in ("ax", "ay", "aw", "ah")]
    boxes, picked = {c: [] for c in ("label", "roi", "window")}, {c: [] for c in ("beside", "within", "inside", "near")}
    asked = {*picked} if not wanted else {"near" if c == "plate" else c for c in wanted}
    for k, rule in enumerate(rules):
        part = lambda share, whole: np.trunc(np.nan * whole if share is None else share * whole)
        at = np.flatnonzero(number(pc.equal(labels.keys, rule["anchor"])))
        ax, ay, aw, ah = label = np.full((4, n_pages), np.nan)
        for cells, found in zip(label, label_box, strict=True):
            cells[label_page[at]] = found[at]
        labelled = ~np.isnan(ax)
        pick = lambda own, other: np.where(labelled & (rule["dx"] is not None), own, other)
        roi = np.array(clip(
            pick(ax + part(rule["dx"], width), part(rule["fx"], width)), pick(ay + part(rule["dy"], height), part(rule["fy"], height)),
            pick(np.fmax(1, part(rule["dw"], width)), np.fmax(1, part(rule["fw"], width))), pick(np.fmax(1, part(rule["dh"], height)), np.fmax(1, part(rule["fh"], height))),
        ))
        roi[:, ~pick(True, rule["fx"] is not None).astype(bool)] = np.nan
        ml, mt, mr, mb = (np.nan if rule[c] is None else rule[c] for c in ("ml", "mt", "mr", "mb"))
        if rule["direction"] == "right":
            cells = ax + aw + part(ml, width), ay - part(mt, height), part(mr - ml, width), ah + part(mb + mt, height)
        else:
            cells = ax - part(ml, width), ay + ah + part(mt, height), aw + part(mr + ml, width), part(mb - mt, height)
        window = np.array(clip(cells[0], cells[1], np.fmax(1, cells[2]), np.fmax(1, cells[3])))
        window[:, ~labelled] = np.nan
        for c, box in (("label", label), ("roi", roi), ("window", window)):
            boxes[c].append(box)
        # Comparisons with NaN are false, so words without a place and pages without a box have none.
        bx, by, bw, bh = roi[:, page]
        tests = {"within": lambda: able & (cx >= bx) & (cx <= bx + bw) & (cy >= by) & (cy <= by + bh)}
        if "prefer_anchor" not in rule or rule["prefer_anchor"]:
            wx, wy, ww, wh = window[:, page]
            tests["beside"] = lambda: able & (cx >= wx) & (cx <= wx + ww) & (cy >= wy) & (cy <= wy + wh)
        if rule["field"] in REGION_FIELDS or wanted == ("inside",):
            tests["inside"] = lambda: (x >= bx) & (y >= by) & (x + w <= bx + bw) & (y + h <= by + bh)
        if rule["field"] == "plate":
            lowest = np.fmin(height, np.fmax(roi[1] + 2 * roi[3], part(0.46, height)))
            lowest[np.isnan(roi[0])] = np.nan
            tests["near"] = lambda: (cy <= lowest[page]) & (cx <= part(0.68, width)[page]) & (conf >= 10)
        for c, test in tests.items():
            if c in asked:
                at = np.flatnonzero(test())
                picked[c].append((page[at] * n_rules + k, at))

    def words_of(name: str) -> tuple[np.ndarray, np.ndarray]:
        none = np.zeros(0, np.int64)
        groups, at = (np.concatenate([none, *cells]) for cells in (zip(*picked[name], strict=True) if picked[name] else ((), ())))
        return groups, at

    by_page = lambda box: np.stack([cells.T for cells in box], 1).reshape(-1, 4).T
    below = np.array([r["direction"] is not None and r["direction"] != "right" for r in rules])

    def best_line(name: str) -> pa.Array:
        """The best line of each page and rule; of lines with one rank the surest, then by x, y and number."""
        groups, at = words_of(name)
        order = np.lexsort((no[at], x[at], *(c[at] for c in reversed(ids)), groups))
        groups, at = groups[order], at[order]
        first = np.zeros(len(at), bool)
        first[:1] = True
        for c in (groups, *(c[at] for c in ids)):
            first[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(first)
        of_line = np.cumsum(first) - 1
        reduced = lambda how, c: how.reduceat(c[at], starts) if len(at) else np.zeros(0)
        lx, ly = reduced(np.minimum, x), reduced(np.minimum, y)
        lw, lh = reduced(np.maximum, x + w) - lx, reduced(np.maximum, y + h) - ly
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[starts, len(at)], pa.int32()), text.take(pa.array(at))), " ")
        unsure = -np.bincount(of_line, conf[at], len(starts)) / np.bincount(of_line, minlength=len(starts))
        group = groups[starts]
        if name == "within":
            roi = by_page(boxes["roi"])[:, group]
            rank, able = np.abs(ly + lh / 2 - roi[1] - roi[3] / 2), np.arange(len(group))
        else:
            ax, ay, aw, ah = by_page(boxes["label"])[:, group]
            like, signs = line_quality(texts)
            down = below[group % n_rules]
            front = np.where(down, ly >= ay + ah - 4, lx >= ax + aw - 4) & (signs >= 2)
            any_front = np.bincount(group, front, n_pages * n_rules) > 0
            rank = np.where(down, np.abs(ly - (ay + ah)) - 2.0 * like, np.abs(ly + lh / 2 - ay - ah / 2) + 0.35 * np.fmax(0, ax + aw - lx) - 2.5 * like)
            able = np.flatnonzero((signs >= 2) & (front | ~any_front[group]))
        order = able[np.lexsort([c[able] for c in (ids[2][at[starts]], ly, lx, unsure, rank, group)])]
        best = order[np.r_[True, group[order[1:]] != group[order[:-1]]]] if len(order) else order
        return placed(group[best], texts.take(pa.array(best)), *(c[best] for c in (lx, ly, lw, lh)))

    def placed(groups: np.ndarray, texts: pa.Array, *box: np.ndarray) -> pa.Array:
        """The texts and boxes of groups (pages and rules, each once) as a struct for each page and rule; null for others."""
        place = np.full(n_pages * n_rules, -1)
        place[groups] = np.arange(len(groups))
        chosen = pa.array(place, mask=place < 0)
        columns = [texts, *(pa.array(c, from_pandas=True).cast(pc.struct_field(flat, n).type) for n, c in zip("xywh", box, strict=True))]
        return pa.StructArray.from_arrays([c.take(chosen) for c in columns], names=["text", "x", "y", "w", "h"], mask=pa.array(place < 0))

    def read_inside() -> tuple[pa.Array, pa.Array]:
        """The words inside each region in reading order, as one text and box, and the token that is a vehicle's type with its word's box: the first with letters and digits, else the first."""
        groups, at = words_of("inside")
        order = np.lexsort((no[at], x[at], y[at], groups))
        groups, at = groups[order], at[order]
        starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(at) else np.zeros(0, np.int64)
        least = lambda c: np.fmin.reduceat(c[at], starts) if len(at) else np.zeros(0)
        most = lambda c: np.fmax.reduceat(c[at], starts) if len(at) else np.zeros(0)
        read = text.take(pa.array(at))
        ends = np.r_[0, np.cumsum(number(read.is_valid()))][np.r_[starts, len(at)]]
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), read.drop_null()), " ")
        whole_box = least(x), least(y), most(x + w) - least(x), most(y + h) - least(y)
        inside = placed(groups[starts], texts, *whole_box)
        pattern, year = re.compile("[A-Z0-9.-]+"), re.compile("[0-9]{4}")
        kinds = {}
        here = np.flatnonzero(of_type[groups % n_rules])
        for group, k, t in zip(groups[here].tolist(), at[here].tolist(), read.take(pa.array(here)).to_pylist(), strict=True):
            for token in tokens_of(t, pattern) if t else ():
                if len(token) > 1 and token not in NO_TYPES and not year.fullmatch(token):
                    mixed = bool(re.search("[A-Z]", token) and re.search("[0-9]", token))
                    if group not in kinds or (mixed and not kinds[group][0]):
                        kinds[group] = mixed, token, k
        words = np.array([k for _, _, k in kinds.values()], np.int64)
        return inside, placed(np.array([*kinds], np.int64), pa.array([t for _, t, _ in kinds.values()], pa.string()), *(c[words] for c in (x, y, w, h)))

    def best_plate() -> pa.Array:
        """The plate of each page and plate rule with the best score, which falls with the distance from the region; then the first by place."""
        groups, at = words_of("near")
        order = np.lexsort((no[at], x[at], *(c[at] for c in reversed(ids)), groups))
        groups, at = groups[order], at[order]
        lines = np.zeros(len(at), np.int64)
        for c in (groups, *(c[at] for c in ids)):
            lines[1:] += c[1:] != c[:-1]
        found = plate_runs(text.take(pa.array(at)).to_pylist(), np.cumsum(lines))
        roi = by_page(boxes["roi"])
        best = {}
        for first, last, token_no, n, raw in found:
            group, cells = int(groups[first]), at[first : last + 1]
            left, top = x[cells].min(), y[cells].min()
            bx, by, bw, bh = (int(c) for c in clip_to(group // n_rules, left, top, (x[cells] + w[cells]).max() - left, (y[cells] + h[cells]).max() - top))
            rx, ry, rw, rh = roi[:, group]
            across, down = abs(bx + bw / 2 - rx - rw / 2) / max(1, width[group // n_rules]), abs(by + bh / 2 - ry - rh / 2) / max(1, height[group // n_rules])
            # As score_of has it for a plate: its length, and twelve for the pattern; twelve more for the place.
            score = len(raw) + 24 - int(np.rint(10 * (across + down))) - (12 if tail.search(raw) else 0)
            key = (-score, by, bx, no[at[first]], token_no, n, raw, bw, bh)
            best[group] = min(best.get(group, key), key)
        place = np.full(n_pages * n_rules, -1)
        place[[*best]] = np.arange(len(best))
        chosen = pa.array(place, mask=place < 0)
        cells = [(raw, -lost, bx, by, bw, bh) for lost, by, bx, _, _, _, raw, bw, bh in best.values()]
        columns = [pa.array([c[k] for c in cells], pa.int32() if k else pa.string()) for k in range(6)]
        return pa.StructArray.from_arrays([c.take(chosen) for c in columns], names=["text", "score", *"xywh"], mask=pa.array(place < 0))

    tail = re.compile(TYPE_TAIL)
    clip_to = lambda p, bx, by, bw, bh: (lambda cx, cy: (cx, cy, max(1, min(bw, width[p] - cx)), max(1, min(bh, height[p] - cy))))(max(0, min(bx, width[p] - 1)), max(0, min(by, height[p] - 1)))
    of_type = np.array([r["field"] == "type" for r in rules])
    inside, kind = read_inside()

    def column(cells: np.ndarray) -> pa.Array:
        return pa.array(cells.ravel(), pa.float64(), from_pandas=True).cast(pa.int32())

    def boxed(name: str) -> list[np.ndarray]:
        return [np.stack([box[c] for box in boxes[name]], 1) for c in range(4)]

    as_struct = lambda cells: pa.StructArray.from_arrays([column(c) for c in cells], names=list("xywh"), mask=pa.array(np.isnan(cells[0].ravel())))
    columns = [pa.array(np.tile(np.arange(n_rules), n_pages), pa.int32()), *map(column, boxed("label")), as_struct(boxed("roi")), as_struct(boxed("window")), best_line("beside"), best_line("within"), inside, kind, best_plate()]
    held = pa.StructArray.from_arrays(columns, names=["rule_no", "ax", "ay", "aw", "ah", "roi", "window", "beside", "within", "inside", "kind", "plate"])
    return pa.ListArray.from_arrays(pa.array(np.arange(n_pages + 1) * n_rules, pa.int32()), held)


def page_candidates(table: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, field, roi, method, raw, priority, cand_no, bonus, plate_score and value_box of all candidates that a page's words give, and a row without a method for fields that have none.

    plate_score is the score of a plate, which is not cleaned; bonus comes on top of the score of owners, types and serial
    numbers, which are read again after cleaning.
    """
    read = page_readings(table, rules)
    return read.select("page_id", "field", "roi", "raw", F.inline_outer("cells"))


def page_readings(table: DataFrame, rules: DataFrame) -> DataFrame:
    """page_candidates by text: page_id, field, roi, raw and cells, the candidates whose text is raw; so that a text is cleaned once, however often a page gives it to a field."""
    lines = region_table(table, rules)
    field = F.col("field")
    cell = lambda method, raw, priority, number, box, bonus=None, score=None: F.struct(method.alias("method"), raw.alias("raw"), F.lit(priority).alias("priority"), F.lit(number).alias("cand_no"), F.lit(bonus).cast("int").alias("bonus") if not isinstance(bonus, Column) else bonus.alias("bonus"), (F.lit(None).cast("int") if score is None else score).alias("plate_score"), box.alias("value_box")).cast(CELL)
    beside = F.when(F.col("beside").isNotNull(), cell(F.when(F.col("direction") != "right", "anchor_below_line").otherwise("anchor_right_line"), F.col("beside.text"), 4, 3, fitted(F.col("beside"))))
    within = F.when(F.col("within").isNotNull(), cell(F.lit("roi_line"), F.col("within.text"), 3, 4, fitted(F.col("within"))))
    plate = F.when(F.col("plate").isNotNull(), cell(F.lit("semantic_plate_page_words"), F.col("plate.text"), 6, 0, as_box(tuple(F.col(f"plate.{c}") for c in "xywh")), None, F.col("plate.score")))
    # Owners are the whole text of their regions, serial numbers are found in it.
    texts = behind(lines, read=F.when(F.col("inside").isNotNull() & (field != "type"), collapsed(F.col("inside.text"))))
    serial = F.coalesce(*[F.nullif(collapsed(F.regexp_extract(folded(F.col("read")), p, 1)), F.lit("")) for p in SERIALS])
    met = behind(texts, reading=F.when(field == "type", F.col("kind.text")).when(field == "serial_no", serial).otherwise(F.col("read")))
    method = F.when(field == "type", "semantic_vehicle_type_roi_words").when(field == "serial_no", "semantic_serial_roi_words").otherwise("semantic_owner_roi_words")
    box = F.when(field == "type", F.col("kind")).otherwise(F.col("inside"))
    region = F.when(field.isin(*REGION_FIELDS) & F.col("reading").isNotNull(), cell(method, F.col("reading"), 5, 1, fitted(box), F.when(field.isin("type", "serial_no"), 8).otherwise(6)))
    made = behind(met, cells=F.array_compact(F.array(plate, region, beside, within)))
    key = F.struct("rule_set", "page_id") if "rule_set" in rules.columns else F.col("page_id")
    own = lambda c: F.struct(*[c[n].alias(n) for n in ("method", "priority", "cand_no", "bonus", "plate_score", "value_box")])
    texts = F.transform(F.array_distinct(F.transform("cells", lambda c: c["raw"])), lambda r: F.struct(r.alias("raw"), F.transform(F.filter("cells", lambda c: c["raw"].eqNullSafe(r)), own).alias("cells")))
    return made.select(key.alias("page_id"), "field", "roi", F.inline_outer(texts))
