"""What is read from one page at a time: lines of words, islands, grids, and the cells of records under a header.

Spark gathers a page's words into a row, deals the pages out, and types the texts that are read here; what a call holds is
bounded by a sheet of paper. As array expressions the same rules are interpreted node by node, at several times the work.
Coordinates that are no numbers lie beyond all others, as in Spark's order.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

TEXT, NUMBER = pa.string(), pa.int32()
TABLES = pa.list_(pa.list_(pa.list_(TEXT)))
DIGIT = re.compile("[0-9]")
#: The end of a text as Spark's patterns have it: before a line's end too.
END = r"(?:\r\n|[\n\r\x85\u2028\u2029])?\Z"


def _values(a: pa.Array) -> list:
    if pa.types.is_nested(a.type):
        out = [None] * len(a)
        for i in np.flatnonzero(a.is_valid().to_numpy(zero_copy_only=False)) if a.null_count else range(len(a)):
            out[i] = a[i].as_py()
        return out
    if pa.types.is_string(a.type) or pa.types.is_large_string(a.type):
        return a.to_numpy(zero_copy_only=False).tolist()
    numbers = (a.fill_null(0) if a.null_count else a).to_numpy()
    out = (np.nan_to_num(numbers, nan=np.inf, posinf=np.inf, neginf=-np.inf) if pa.types.is_floating(a.type) else numbers).tolist()
    for i in np.flatnonzero(a.is_null().to_numpy(zero_copy_only=False)) if a.null_count else ():
        out[i] = None
    return out


def lists(a: pa.Array) -> list:
    """A list of tuples for each row of an array of structs."""
    at, structs = a.offsets.to_pylist(), a.values
    rows = list(zip(*(_values(structs.field(i)) for i in range(structs.type.num_fields)), strict=True))
    return [rows[i:j] for i, j in zip(at, at[1:])]


def by_page(pages: DataFrame, keys: list[str], given: list[str], out: list[tuple[str, str, pa.DataType]], read: Callable[..., Iterable[tuple]]) -> DataFrame:
    """The keys, and the columns (name, type, Arrow type) of the rows that `read` gives for a page's arrays of structs."""
    names = [*keys, *(name for name, _, _ in out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, page in enumerate(zip(*(lists(batch.column(c)) for c in given), strict=True)):
                for r in read(*page):
                    at.append(i)
                    rows.append(r)
            columns = zip(*rows, strict=True) if rows else [()] * len(out)
            whole, places = at == list(range(batch.num_rows)), pa.array(at, pa.int64())
            told = [pa.array(c, kind) for c, (_, _, kind) in zip(columns, out, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) if whole else batch.column(k).take(places) for k in keys), *told], names)

    schema = StructType([pages.schema[k] for k in keys] + StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind, _ in out)).fields)
    return pages.select(*dict.fromkeys([*keys, *given])).mapInArrow(run, schema)


def by_batch(pages: DataFrame, keys: list[str], given: list[str], out: list[tuple[str, str]], read: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.RecordBatch, np.ndarray, list[pa.Array]]]]) -> DataFrame:
    """As `by_page`, for what is read of all pages of a batch at once: `read` gives each batch, its rows' pages and their columns."""
    names = [*keys, *(name for name, _ in out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, at, columns in read(batches):
            whole, rows = np.array_equal(at, np.arange(batch.num_rows)), pa.array(at)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) if whole else batch.column(k).take(rows) for k in keys), *columns], names)

    schema = StructType([pages.schema[k] for k in keys] + StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in out)).fields)
    return pages.select(*dict.fromkeys([*keys, *given])).mapInArrow(run, schema)


def flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.StructArray]:
    """Where each list begins, the last one's end too, the list that each struct is of, and the structs."""
    at = lists.offsets.to_numpy().astype(np.int64)
    return at - at[0], np.repeat(np.arange(len(lists)), np.diff(at)), lists.values.slice(at[0], at[-1] - at[0])


def places(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates, what is no number beyond all others, and whether there is one."""
    return np.nan_to_num(a.to_numpy(zero_copy_only=False), nan=np.inf, posinf=np.inf, neginf=-np.inf), a.is_valid().to_numpy(zero_copy_only=False)


def rounded(x: float) -> float:
    """To a whole number, half to even; what lies beyond all others stays there."""
    return round(x) if -np.inf < x < np.inf else x


def gathered(texts: pa.Array, which: np.ndarray, of: np.ndarray, n: int) -> pa.Array:
    """n texts: those of `texts` that are chosen, joined by spaces for each number of `of`, which ascends."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(of[which], minlength=n))]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), texts.filter(pa.array(which))), " ")


def islands(spans: Iterable[tuple], gap: float) -> list[list]:
    """The union of spans (lo, hi) as spans from left to right; those at most `gap` apart are one, those without a begin come first."""
    out: list[list] = []
    for lo, hi in sorted(spans, key=lambda s: [(v is not None, v or 0.0) for v in s]) if any(None in s for s in spans) else sorted(spans):
        if out and lo is not None and out[-1][1] is not None and lo <= out[-1][1] + gap:
            if hi is not None and hi > out[-1][1]:
                out[-1][1] = hi
        else:
            out.append([lo, hi])
    return out


def grid(words: list[tuple], gap: float) -> list[list[str]] | None:
    """The grid that a page's words (top, x0, x1, bottom, text) form, in their order; None if it has less than two columns or rows."""
    rows = islands([(w[0], w[3]) for w in words], 0.0)
    lines: list[list[tuple]] = [[] for _ in rows]
    begins = [r[0] for r in rows if r[0] is not None]
    without = len(rows) - len(begins)
    for w in words:
        if w[0] is not None and (i := bisect_right(begins, w[0]) + without - 1) >= without and rows[i][1] is not None and w[0] <= rows[i][1]:
            lines[i].append(w)
    tabular = [ws for ws in lines if len(ws) > 1 and len(islands([(w[1], w[2]) for w in ws], gap)) > 1]
    if len(tabular) < 2:
        return None
    columns = islands([(w[1], w[2]) for ws in tabular for w in ws], gap)
    if len(columns) < 2:
        return None
    begins = [c[0] for c in columns if c[0] is not None]
    out = []
    for ws in lines:
        cells: list[list[str]] = [[] for _ in columns]
        for w in ws:  # a word stands in the last column that begins at or left of it; what stands left of all is the first's
            if w[1] is not None and ((i := bisect_right(begins, w[1])) or columns[0][0] is not None):
                cells[max(i - 1, 0)].append(w[4])
        out.append([" ".join(c) for c in cells])
    return out


def risen(v: np.ndarray, run: np.ndarray) -> np.ndarray:
    """The greatest value of each run up to each place; runs are numbers that stand together."""
    at = np.arange(len(v))
    within = at - np.maximum.accumulate(np.where(np.concatenate([[True], run[1:] != run[:-1]])[: len(v)], at, 0))
    v, step = v.copy(), 1
    while step <= within.max(initial=0):
        later = np.flatnonzero(within >= step)
        v[later] = np.maximum(v[later], v[later - step])
        step *= 2
    return v


def begun(lo: np.ndarray, hi: np.ndarray, run: np.ndarray, gap: float) -> np.ndarray:
    """Where the islands of each run's spans begin; lo ascends within a run, no span ends before it begins."""
    out = np.concatenate([[True], run[1:] != run[:-1]])[: len(run)]
    out[1:] |= lo[1:] > risen(hi, run)[:-1] + gap
    return out


def grids(lists_: pa.ListArray, which: np.ndarray, gap: float) -> tuple[np.ndarray, np.ndarray, pa.ListArray]:
    """What `grid` gives for each chosen page that has one: the page and the number of each row, and its cells.

    Pages whose words all have places that are numbers are read at once, others by `grid` itself.
    """
    n = len(lists_)
    _, of, structs = flat(lists_)
    if not which.all():
        chosen = which[of]
        of, structs = of[chosen], structs.filter(pa.array(chosen))
    top, x0, x1, bottom = span = [structs.field(i).to_numpy(zero_copy_only=False) for i in range(4)]
    sound = np.isfinite(span).all(axis=0) & (top <= bottom) & (x0 <= x1)
    odd = np.unique(of[~sound])
    told = []
    for p, ws in zip(odd, lists(lists_.take(pa.array(odd))) if len(odd) else (), strict=True):
        told += [(p, i, cells) for i, cells in enumerate(grid(ws, gap) or ())]
    if len(odd):
        kept = ~np.isin(of, odd)
        of, structs, (top, x0, x1, bottom) = of[kept], structs.filter(pa.array(kept)), (v[kept] for v in span)
    row = np.cumsum(begun(top, bottom, of, 0.0)) - 1
    by = np.lexsort((x0, row))
    parts = np.bincount(row[by][begun(x0[by], x1[by], row[by], gap)])
    page = of[np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])[: len(row)])]  # of each row
    rows = np.bincount(page, minlength=n)
    tabular = (parts > 1)[row]
    by = np.lexsort((~tabular, x0, of))  # of words that begin at one place, those that make columns come first
    begins = begun(x0[by], np.where(tabular, x1, -np.inf)[by], of[by], gap) & tabular[by]
    columns = np.bincount(of[by][begins], minlength=n)
    good = (np.bincount(page[parts > 1], minlength=n) > 1) & (columns > 1)
    before = lambda counts: np.cumsum(counts) - counts
    column = np.empty(len(of), np.int64)
    column[by] = np.maximum(np.cumsum(begins) - before(columns)[of[by]] - 1, 0)
    sizes = rows * columns * good
    cell = before(sizes)[of] + (row - before(rows)[of]) * columns[of] + column
    words = np.flatnonzero(good[of])
    words = words[np.argsort(cell[words], kind="stable")]
    texts = gathered(structs.field(4).take(pa.array(words)), np.ones(len(words), bool), cell[words], int(sizes.sum()))
    page = page[good[page]]
    cells = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(columns[page])]), pa.int32()), texts)
    number = np.arange(len(page)) - before(rows * good)[page]
    if not told:
        return page, number, cells
    by_grid = list(zip(*told, strict=True))
    page, number = np.concatenate([page, by_grid[0]]), np.concatenate([number, by_grid[1]])
    by = np.argsort(page, kind="stable")
    return page[by], number[by], pa.concat_arrays([cells, pa.array(by_grid[2], cells.type)]).take(pa.array(by))


def lines_of(words: list[tuple], tolerance: float) -> list[list[tuple]]:
    """Lines of words (x0, top, x1, text), in their order: a line goes on while a word lies near the line's highest word."""
    line, start, n = {}, None, -1
    for t in sorted({w[1] for w in words if w[1] is not None}):
        if start is None or not (t == start or t - start <= tolerance):
            start, n = t, n + 1
        line[t] = n
    lines: list[list[tuple]] = [[] for _ in range(n + 1)]
    for w in words:
        if w[1] is not None:
            lines[line[w[1]]].append(w)
    return lines if all(w[1] is not None for w in words) else [*lines, []]


def under(head: Iterable[tuple[str | None, object]], rules: list[tuple[str, str]]) -> dict[str, object]:
    """Fields of header texts: each takes its first rule (keyword, field) whose field is still free, and what stands beside it."""
    fields: dict[str, object] = {}
    for title, place in head:
        if title is not None and (f := next((f for k, f in rules if k in title and f not in fields), None)) is not None:
            fields[f] = place
    return fields


def paid_lines(words: list[tuple], rules: list[tuple[str, str]], amount_heads: str, name_heads: str, line_apart: float, column_apart: float, block_apart: float, block_lines: int, read: list[str]) -> Iterator[tuple]:
    """(line, texts of `read`, texts left of all columns) of the lines below a page's header that have a digit in the amount's column;
    the amount's text is the line's, others are those of the line and the lines above it. See `pages.word_records`."""
    lines = lines_of(words, line_apart)
    if len(lines) < 3 or sum(map(len, lines)) < 5:
        return
    texts = [re.sub("[ 　]", "", "".join(w[3] for w in ws if w[3] is not None)) for ws in lines[:14]]
    heads = ((s, n) for s in range(12) for n in (1, 2, 3) if s + n <= len(lines))
    head = next(((s, n) for s, n in heads if re.search(amount_heads, t := "".join(texts[s : s + n])) and re.search(name_heads, t)), None)
    if head is None:
        return
    centre = lambda w: None if w[0] is None or w[2] is None else (w[0] + w[2]) / 2
    titles = ((w[3] and re.sub("[ 　]", "", w[3]), centre(w)) for ws in lines[head[0] : sum(head)] for w in ws)
    fields = under(titles, rules)
    if "contract_amount" not in fields:
        return
    body = [[(centre(w), w[3]) for w in ws if w[3] is not None] for ws in lines[sum(head) :]]
    tops = [ws[0][1] if ws else None for ws in lines[sum(head) :]]
    edge = min((x for x in fields.values() if x is not None), default=None)

    def near(ws: list[tuple], field: str) -> str:
        x = fields.get(field)
        return "" if x is None else " ".join([t for c, t in ws if c is not None and abs(c - x) <= column_apart])

    for i, ws in enumerate(body):
        amount = near(ws, "contract_amount")
        if not DIGIT.search(amount):
            continue
        block = [w for j in range(max(i - block_lines, 0), i + 1) if tops[j] is not None and tops[j] >= tops[i] - block_apart for w in body[j]]
        left = "" if edge is None else " ".join(dict.fromkeys(t for c, t in block if c is not None and c < edge - 5))
        yield i, *((amount if f == "contract_amount" else near(block, f)) or None for f in read), left or None


def paid_rows(tables: list[list[list[str]]], rules: list[tuple[str, str]], amounts: str, names: str, header_rows: int, ditto: list[str], read: list[str]) -> Iterator[tuple]:
    """(table, row, texts of `read`, text right of the name) of the rows below each table's header that have a digit in the amount's
    column; ditto marks are replaced by the method before them. See `layouts.table_records`."""
    for t, rows in enumerate(tables):
        if len(rows) < 2:
            continue
        rows = [[c or "" for c in r or ()] for r in rows]
        flat = [re.sub("[\n 　]", "", "".join(r)) for r in rows[:header_rows]]
        head = next((i for i, text in enumerate(flat) if re.search(amounts, text) and re.search(names, text)), None)
        if head is None:
            continue
        fields = under(((re.sub("[\n ]", "", c), i) for i, c in enumerate(rows[head])), rules)
        if "contract_amount" not in fields:
            continue
        places = [fields.get(f, -1) for f in read]
        method, amount, beside = fields.get("bid_method", -1), fields["contract_amount"], fields.get("contract_name", -2) + 1
        before = None
        for i in range(head + 1, len(rows)):
            r = rows[i]
            cell = lambda p: r[p] if 0 <= p < len(r) else None  # noqa: B023, E731
            mark = (cell(method) or "").strip(" ")
            if 0 <= method < len(r) and mark in ditto:
                r[method] = before
            elif mark:
                before = mark
            if DIGIT.search(cell(amount) or ""):
                yield t, i, *map(cell, places), cell(beside)
