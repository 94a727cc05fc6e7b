"""Personal data (operator 2): candidate gradient boosting, in DataFrame functions only.

Base spans come from four fixed patterns with their checks (parts of an address, digits, Luhn) and always stay. Looser
generators then propose further spans of the same kinds (addresses spelt with [at] or (dot), numbers without a plus,
cards with other separators); every candidate gets format and context features, boosted trees of two levels score it,
and its kind's threshold decides, which is fitted on shapes (ways to spell a value) that the trees behind it did not see.
No labels of personal data exist here, so the trees learn from TEMPLATES made texts of a fixed seed: personal values in
many national and spelt forms against places, prices, dates, versions, reference numbers and failed checks of the same
shapes, with cue words on either side and a share of labels that are wrong. `measured` gives precision and recall on
unseen shapes of another seed.

Places come from regular functions: a pattern's matches and the gaps that it leaves, added up in code points. Sums and
greatest values along a text's matches go by runs, overlaps are sought run by run, and parts of a text are cut from its
chunks, so the time for a text grows little faster than its length.

Cases: null and empty texts have no spans; very long ones are judged whole; of candidates that overlap a base span none is
added, and of a kind's candidates that overlap the leftmost stands; rows of equal doc_id are each judged; an empty table gives no rows; other
columns play no part in spans and are kept by `redacted`, which writes [KIND] for each span (the first one's kind for
spans that overlap) and corrects n_chars.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._base import table

KINDS = ["email", "ip", "card", "phone"]
#: The base patterns, each written so that it finds the same spans in time that grows with the text alone.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}(?: ?(?:\[dot\]|\(dot\)|\{dot\}) ?[a-z0-9._%+-]{1,64}){0,2}(?: ?(?:@|\[at\]|\(at\)|\{at\}) ?| at (?=[a-z0-9-]{1,63} dot ))[a-z0-9-]{1,63}(?:(?:\.| ?(?:\[dot\]|\(dot\)|\{dot\}|\[\.\]) ?| dot )[a-z0-9-]{2,63}){1,4}",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:(?:\.|\[\.\]|\(\.\)| \. )[0-9]{1,3}){3}(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}(?:[ ._/-]{0,2}[0-9]{2,6}){2,5}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:00|\()?[0-9]{2,5}\)?(?:[ ./-]{1,2}[0-9]{2,5}){2,4}(?![0-9A-Za-z])",
}
#: A text without this has no loose candidate of the kind beyond the base ones.
HINT = {"email": r"(?i)[\[({](?:at|dot|\.)[\])}]|@ | @| at [a-z0-9-]{1,63} dot ", "ip": r"[0-9](?:\[\.\]|\(\.\)| \. )[0-9]", "card": r"[0-9]{4}[ ._/-]{0,2}[0-9]{2}", "phone": r"[0-9]{2}\)?[ ./-]{1,2}[0-9]{2}"}
CUE = {"email": r"(?i)(?:mail|contact|write|reach|addr)", "ip": r"(?i)(?:\bip\b|host|server|addr|login|from)", "card": r"(?i)(?:card|visa|master|amex|credit|debit|pay)", "phone": r"(?i)(?:tel|phone|call|fax|mobile|cell|dial|whatsapp|number)"}
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: Last labels by which an address is likelier one; what ends otherwise is judged by the rest.
ENDINGS = ["com", "org", "net", "edu", "gov", "info", "io", "eu", "de", "fr", "es", "it", "uk", "us", "nl", "ch", "at", "jp"]
BEFORE = 24
#: Matches in a run, and code points in a chunk.
RUN, CHUNK = 64, 512
SPAN = "array<struct<kind:string,start:int,end:int>>"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value computed once a row: what stands in a lambda itself is computed for each element."""
    return F.transform(F.array(value), f)[0]


def in_runs(xs: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(xs) - 1, F.lit(0)) / RUN).cast("int")), lambda r: F.slice(xs, r * RUN + 1, F.lit(RUN)))


def running(xs: Column, add: Callable[[Column, Column], Column]) -> Column:
    """Each whole number added up (or otherwise folded, from 0) with all before it."""
    folded = lambda ys, zero: F.aggregate(ys, zero, add)

    def with_totals(runs: Column) -> Column:
        return let(F.struct(runs.alias("runs"), F.transform(runs, lambda y: folded(y, F.lit(0))).alias("totals")), placed)

    def placed(x: Column) -> Column:
        within = lambda run, before: F.transform(run, lambda _, j: folded(F.slice(run, F.lit(1), j + 1), before))
        return F.flatten(F.transform(x["runs"], lambda run, r: let(folded(F.slice(x["totals"], F.lit(1), r), F.lit(0)), lambda before: within(run, before))))

    return let(xs, lambda held: let(in_runs(held), with_totals))


def chunked(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def cut(chunks: Column, start: Column, n: Column) -> Column:
    """n code points from `start`, without reading the text up to there."""
    first, last = F.floor(start / CHUNK).cast("int"), F.floor((start + n - 1) / CHUNK).cast("int")
    part = F.array_join(F.slice(chunks, first + 1, F.greatest(last - first + 1, F.lit(0))), "")
    return F.when(n > 0, F.substr(part, start - first * CHUNK + 1, n)).otherwise("")


def spans(text: Column, found: Column, pattern: str) -> Column:
    """(match, start, end) of each match, in code points: a match ends where the gaps and matches up to it do."""
    steps = F.zip_with(F.transform(F.split(text, pattern, -1), lambda g: F.length(g)), F.transform(found, lambda m: F.length(m)), lambda g, m: g + F.coalesce(m, F.lit(0)))
    ends = F.slice(running(steps, lambda a, x: a + x), F.lit(1), F.size(found))
    placed = F.zip_with(found, ends, lambda m, e: F.struct(m.alias("match"), (e - F.length(m)).alias("start"), e.alias("end")))
    return F.when(F.size(found) > 0, placed).otherwise(F.from_json(F.lit("[]"), "array<struct<match:string,start:int,end:int>>"))


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(number: Column) -> Column:
    n = F.length(number)

    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substr(number, n - i + 1, F.lit(1))) - 48
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return luhn(digits(match))
    if kind == "phone":
        return F.length(digits(match)).between(8, 15)
    return F.lit(True)


def holds(kind: str) -> Callable[[Column], Column]:
    return lambda s: valid(kind, s.match)


def with_spans(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs, which must have `text`, with `_base` and `_all` (arrays of kind, start, end)."""
    text = F.coalesce("text", F.lit(""))
    first = {"email": F.instr(text, "@") > 0, "ip": F.instr(text, ".") > 0, "card": F.lit(True), "phone": F.instr(text, "+") > 0}
    none = F.array().cast("array<string>")
    docs = docs.withColumns({f"_m_{k}": F.when(first[k], F.regexp_extract_all(text, F.lit(BASE[k]), F.lit(0))).otherwise(none) for k in KINDS})
    docs = docs.withColumns({f"_b_{k}": F.filter(spans(text, F.col(f"_m_{k}"), BASE[k]), holds(k)) for k in KINDS})
    bare = lambda k, c: F.transform(c, lambda s: F.struct(F.lit(k).alias("kind"), s.start.alias("start"), s.end.alias("end")))
    docs = docs.withColumn("_base", F.concat(*(bare(k, F.col(f"_b_{k}")) for k in KINDS)))
    if model is None:
        return docs.withColumn("_all", F.col("_base")).drop(*(f"_{x}_{k}" for k in KINDS for x in "mb"))
    docs = docs.withColumns({f"_m_{k}": F.when(text.rlike(HINT[k]), F.regexp_extract_all(text, F.lit(LOOSE[k]), F.lit(0))).otherwise(none) for k in KINDS})

    bounds = lambda run: F.struct(run.alias("spans"), F.array_min(F.transform(run, lambda b: b.start)).alias("lo"), F.array_max(F.transform(run, lambda b: b.end)).alias("hi"))
    any_loose = reduce(lambda a, b: a | b, [F.size(f"_m_{k}") > 0 for k in KINDS])
    docs = docs.withColumns({"_runs": F.when(any_loose, F.transform(in_runs(F.col("_base")), bounds)), "_chunks": F.when(any_loose, chunked(text))})

    def fresh(k: str) -> Callable[[Column], Column]:
        overlaps = lambda b, s: (b.start < s.end) & (s.start < b.end)
        taken = lambda s: F.exists("_runs", lambda r: (r.lo < s.end) & (s.start < r.hi) & F.exists(r.spans, lambda b: overlaps(b, s)))
        values = lambda s: F.struct(*(c.alias(f) for f, c in features(k, F.col("_chunks"), s).items()))
        return lambda s: ~taken(s) & let(values(s), lambda x: model.accepts(k, {f: x[f] for f in FEATURES}))

    more = {k: F.when(F.size(f"_m_{k}") > 0, F.filter(spans(text, F.col(f"_m_{k}"), LOOSE[k]), fresh(k))) for k in KINDS}
    docs = docs.withColumns({f"_x_{k}": F.coalesce(bare(k, more[k]), F.from_json(F.lit("[]"), SPAN)) for k in KINDS})
    order = lambda a, b: a.start - b.start
    docs = docs.withColumn("_all", F.concat(*(F.array_sort(F.concat(bare(k, F.col(f"_b_{k}")), F.col(f"_x_{k}")), order) for k in KINDS)))
    return docs.drop("_runs", "_chunks", *(f"_{x}_{k}" for k in KINDS for x in "mbx"))


FEATURES = ["cue", "digits", "groups", "length", "before_space", "after_space", "luhn", "date", "year", "paren", "zeros", "dots", "octets", "spelt", "even", "ending", "marks"]


def features(kind: str, chunks: Column, s: Column) -> dict[str, Column]:
    m, number = s.match, digits(s.match)
    before = cut(chunks, F.greatest(s.start - BEFORE, F.lit(0)), F.least(s.start, F.lit(BEFORE)))
    last, after = F.substring(before, -1, 1), cut(chunks, s.end, F.lit(1))
    whole = lambda x: x.cast("int")
    return {
        "cue": whole(before.rlike(CUE[kind])), "digits": F.length(number), "groups": F.size(F.split(m, "[^0-9A-Za-z]+")), "length": F.length(m),
        "before_space": whole(last.rlike(r"^[\s:(\"'=]?$")), "after_space": whole(after.rlike(r"^[\s.,;:)\"'!?]?$")),
        "luhn": whole((F.length(number).between(13, 19)) & luhn(number)), "date": whole(m.rlike(r"^[0-9]{1,2}[ ./-][0-9]{1,2}[ ./-](?:[0-9]{4}|[0-9]{2})$")),
        "year": whole(m.rlike(r"(?:^|[^0-9])(?:19|20)[0-9]{2}(?:[^0-9]|$)")), "paren": whole(m.rlike(r"^\(")), "zeros": whole(number.rlike("^00")), "dots": F.length(m) - F.length(F.translate(m, ".", "")),
        "octets": whole(F.regexp_replace(m, r"[\[\]() ]", "").rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")), "spelt": whole(m.rlike(r"(?i)[\[(](?:at|dot|\.)[\])]")), "ending": whole(F.lower(F.regexp_extract(m, "([A-Za-z]+)$", 1)).isin(ENDINGS)), "marks": F.size(F.regexp_extract_all(m, F.lit(r"(?i)[\[({](?:at|dot|\.)[\])}]| (?:at|dot) "), F.lit(0))), "even": whole(m.rlike(r"^\(?[0-9]{3}\)?[ .-]+[0-9]{3}[ .-][0-9]{4}$|^[0-9]{4}(?:[ ._-][0-9]{4}){3}$")),
    }


@dataclass
class Tree:
    """Two levels: a cut, then a cut on either side; `leaves` by (left-left, left-right, right-left, right-right)."""

    cuts: list[tuple[str, float]]
    leaves: list[float]

    def of(self, x: dict) -> float:
        right = x[self.cuts[0][0]] > self.cuts[0][1]
        name, at = self.cuts[1 + right]
        return self.leaves[2 * right + (x[name] > at)]

    def column(self, x: dict[str, Column]) -> Column:
        test = lambda c: x[c[0]] > F.lit(c[1])
        side = lambda k: F.when(test(self.cuts[1 + k]), F.lit(self.leaves[2 * k + 1])).otherwise(F.lit(self.leaves[2 * k]))
        return F.when(test(self.cuts[0]), side(1)).otherwise(side(0))


@dataclass
class Model:
    trees: dict[str, list[Tree]]
    bars: dict[str, float]

    def accepts(self, kind: str, x: dict[str, Column]) -> Column:
        total = F.lit(0.0)
        for t in self.trees[kind]:
            total = total + t.column(x)
        return total >= F.lit(self.bars[kind])


TREES, STEP, RIDGE, PRECISION = 16, 0.3, 1.0, 0.95


def boost(rows: list[dict], y: list[int]) -> list[Tree]:
    """Boosted two-level trees for the logistic loss."""
    options = [(f, (a + b) / 2) for f in FEATURES for v in [sorted({r[f] for r in rows})] for a, b in zip(v, v[1:], strict=False)]
    over, z, trees = np.array([[r[f] > at for r in rows] for f, at in options], float), np.zeros(len(y)), []

    def best(inside: np.ndarray, g: np.ndarray, h: np.ndarray) -> int:
        g, h = g * inside, h * inside
        a, b = over @ g, over @ h
        return int(np.argmax(a**2 / (b + RIDGE) + (g.sum() - a) ** 2 / (h.sum() - b + RIDGE)))

    for _ in range(TREES if options else 0):
        p = 1 / (1 + np.exp(-z))
        g, h = p - np.array(y), p * (1 - p)
        first = best(np.ones(len(y)), g, h)
        cuts, leaves = [options[first]], []
        for side in (1 - over[first], over[first]):
            second = best(side, g, h)
            cuts.append(options[second])
            for own in (side * (1 - over[second]), side * over[second]):
                step = -STEP * float((g * own).sum() / ((h * own).sum() + RIDGE))
                leaves.append(step)
                z = z + step * own
        trees.append(Tree(cuts, leaves))
    return trees


TEMPLATES, SEED, WRONG = 4000, 5, 0.01
#: Names and domains of made addresses, with or without digits, dots and hyphens.
NAMES = ["anna", "john", "mary.smith", "j.doe", "info", "kim_b", "sales", "m-roy", "peter", "office", "li.wei", "support", "x", "contact", "jean-luc", "maria", "team", "a.b", "press", "olga"]
DOMAINS = ["mail", "example", "university", "firm", "company", "web-shop", "north", "post", "institute", "bakery", "my-site", "garden", "clinic", "press", "atlas", "river"]


def made_texts(seed: int = SEED, wrong: float = WRONG) -> list[dict]:
    """Training texts: kind, text, whether the value in it is personal, and the half (`held`) to which its shape belongs: a
    shape, the way a value is spelt, is in one half only."""
    r = random.Random(seed)
    n = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    words = ["of", "the", "report", "und", "les", "con", "said", "item", "table", "see", "für", "page", "order", "que", "number", "from", "chapter", "el", "sur", "total"]
    word = lambda: r.choice(words)
    plain = lambda: r.choice([*words, *DOMAINS, "noon", "home", "two", "lunch", "price", "then", "once"]).replace("ü", "u")
    cues = {"email": ["mail", "contact", "write to", "reach me:"], "ip": ["host", "server", "ip", "login from"], "card": ["card", "visa", "paid with", "credit card no."], "phone": ["phone", "tel.", "call", "fax", "mobile"]}

    def number(length: int, lucky: bool) -> str:
        body = r.choice("3456") + n(length - 2)
        total = sum(int(c) if i % 2 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(body)))
        return body + str((-total + (0 if lucky else r.randrange(1, 10))) % 10)

    def parted(text: str, sizes: list[int], between: str) -> str:
        at, out = 0, []
        for k in sizes:
            out.append(text[at : at + k])
            at += k
        return between.join(out)

    def value(kind: str, good: bool) -> tuple[str, int]:
        """A value and the number of its shape."""
        if kind == "email":
            ways = [(" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", "."), ("[at]", "[dot]"), (" [AT] ", " [DOT] "), (" @ ", "."), ("@ ", "."), ("[at]", "."), (" at ", " dot "), ("{at}", "{dot}"), ("@", "[.]"), (" (at) ", " (dot) ")]
            i = r.randrange(len(ways))
            at, dot = ways[i]
            if good:
                name = r.choice(NAMES) + r.choice(["", "", n(1), n(2)])
                name = name.replace(".", dot) if r.random() < 0.5 else name
                labels = [r.choice(DOMAINS) + r.choice(["", "", "", n(1), n(2)]) for _ in range(r.choice([1, 1, 1, 2]))] + r.choice([["com"], ["org"], ["net"], ["edu"], ["de"], ["fr"], ["es"], ["info"], ["co", "uk"], ["ac", "at"]])
                return name + at + dot.join(labels), i
            # the same ways of writing around what is none: places and times, prices, rates, file names
            left, right = r.choice([(plain(), plain()), (n(1), n(1)), (n(3), n(2)), (plain(), n(2)), (r.choice(NAMES), plain())])
            return left + at + right + dot + r.choice([plain(), plain(), n(2), r.choice(["pdf", "txt", "html"])]), i
        if kind == "ip":
            i, top = r.randrange(4), r.choice([10, 256])
            dot = ["[.]", " . ", ".", "(.)"][i]
            parts = [str(r.randrange(top)) for _ in range(4)]
            if not good and top == 256:
                parts[r.randrange(4)] = str(r.randrange(256, 1000))
            return dot.join(parts) if good or top == 256 else r.choice([" . ", "."]).join(parts), i
        if kind == "card":
            i = r.randrange(8)
            length, sizes = r.choice([(16, [4, 4, 4, 4]), (15, [4, 6, 5]), (16, [4, 4, 4, 4]), (19, [4, 4, 4, 4, 3]), (14, [4, 6, 4])])
            return parted(number(length, good), sizes, [" ", "-", ".", "_", "/", "  ", " -", ". "][i]), i
        marks = [" ", "-", ".", "/"]
        j = r.randrange(len(marks))
        if good:
            shapes = [f"({n(3)}) {n(3)}{{}}{n(4)}", f"{n(3)}{{0}}{n(3)}{{0}}{n(4)}", f"00{n(2)} {n(3)}{{0}}{n(4)}", f"0{n(2)}{{0}}{n(4)}{{0}}{n(4)}", f"0{n(1)}{{0}}{n(2)}{{0}}{n(2)}{{0}}{n(2)}{{0}}{n(2)}", f"(0{n(2)}) {n(4)}{{0}}{n(3)}", f"0{n(3)}{{0}}{n(3)} {n(3)}", f"{n(3)}{{0}}{n(3)}{{0}}{n(3)}"]
        else:
            shapes = [f"{r.randrange(10, 29)}{{0}}{r.randrange(10, 13)}{{0}}20{n(2)}", f"20{n(2)}{{0}}1{r.randrange(3)}{{0}}{r.randrange(10, 29)}", f"{n(2)}{{0}}{n(2)}{{0}}{n(2)}", f"{n(2)}{{0}}{n(3)}{{0}}{n(5)}{{0}}{n(2)}", f"{n(2)}{{0}}{n(2)}{{0}}{n(4)}", f"{n(4)}{{0}}{n(4)}{{0}}{n(4)}", f"{n(3)}{{0}}{n(2)}{{0}}{n(4)}", f"{n(2)}{{0}}{n(3)}{{0}}{n(3)}", f"19{n(2)}{{0}}{n(2)}{{0}}{n(2)}", f"{n(5)}{{0}}{n(5)}{{0}}{n(5)}", f"20{n(2)}{{0}}{n(4)}{{0}}{n(3)}"]
        i = r.randrange(len(shapes))
        return shapes[i].replace("{0}", marks[j]).replace("{}", marks[j]), i + j

    out = []
    for i in range(TEMPLATES):
        kind, good = KINDS[i % 4], r.random() < 0.5
        cue = r.choice(cues[kind]) if r.random() < (0.6 if good else 0.1) else word()
        told, shape = value(kind, good)
        text = f"{word()} {word()} {cue}{r.choice([' ', ': '])}{told}{r.choice([' ', '. ', ', ', '', ')', chr(10)])}"
        out.append({"kind": kind, "text": text + (word() if text[-1] in " \n" else ""), "good": int(good != (r.random() < wrong)), "held": shape % 2})
    return out


def candidates(spark: SparkSession, texts: list[dict]) -> list[dict]:
    """Features of every candidate of the texts, with what is known of its text."""
    rows = []
    for k in KINDS:  # each kind's texts stand in the plan once: plans are kept by the driver
        mine = json.dumps([t for t in texts if t["kind"] == k], ensure_ascii=False)
        own = spark.range(1).select(F.inline(F.from_json(F.lit(mine), "array<struct<kind:string,text:string,good:int,held:int>>")))
        own = own.withColumns({"_m": F.regexp_extract_all("text", F.lit(LOOSE[k]), F.lit(0)), "_chunks": chunked(F.col("text"))}).withColumn("s", F.explode(spans(F.col("text"), F.col("_m"), LOOSE[k])))
        rows.append(own.select("kind", "good", "held", *(c.alias(f) for f, c in features(k, F.col("_chunks"), F.col("s")).items())))
    return sorted((r.asDict() for r in reduce(DataFrame.unionByName, rows).collect()), key=lambda r: json.dumps(r, sort_keys=True))


_trained: list[tuple[Model, list[dict[str, list[Tree]]]]] = []


def trained(spark: SparkSession) -> Model:
    """The model; the same each time, so a process trains it once. Its thresholds come from trees of one half of the shapes on
    texts of the other, its trees from both."""
    return _both(spark)[0]


def _both(spark: SparkSession) -> tuple[Model, list[dict[str, list[Tree]]]]:
    """The model, and for each half of the shapes the trees that have not seen it."""
    if not _trained:
        data, trees, bars, crossed = candidates(spark, made_texts()), {}, {}, [{}, {}]
        for k in KINDS:
            halves = [[r for r in data if r["kind"] == k and r["held"] == h] for h in (0, 1)]
            for h in (0, 1):
                crossed[h][k] = boost(halves[1 - h], [r["good"] for r in halves[1 - h]])
            bars[k] = bar_for([(sum(t.of(r) for t in crossed[h][k]), r["good"]) for h in (0, 1) for r in halves[h]])
            trees[k] = boost(halves[0] + halves[1], [r["good"] for r in halves[0] + halves[1]])
        _trained.append((Model(trees, bars), crossed))
    return _trained[0]


def bar_for(scores: list[tuple[float, int]]) -> float:
    """The lowest score, of those that say yes, from which on PRECISION of the held-out candidates are right."""
    ranked, out, right = sorted(scores, reverse=True), math.inf, 0
    for i, (score, good) in enumerate(ranked):
        right += good
        if score > 0 and right >= PRECISION * (i + 1) and (i + 1 == len(ranked) or ranked[i + 1][0] < score):
            out = (score + max(0.0, ranked[i + 1][0] if i + 1 < len(ranked) else 0.0)) / 2  # between two scores
    return out if out < math.inf else 1e9


def measured(spark: SparkSession, seed: int) -> dict[str, tuple[float, float]]:
    """Precision and recall of each kind's accepted candidates over made texts of another seed, each judged by trees that have
    seen no value of its shape."""
    (model, crossed), out = _both(spark), {}
    data = candidates(spark, made_texts(seed, 0.0))
    for k in KINDS:
        own = [(sum(t.of(r) for t in crossed[r["held"]][k]) >= model.bars[k], r["good"]) for r in data if r["kind"] == k]
        right = sum(yes and good for yes, good in own)
        out[k] = right / max(1, sum(yes for yes, _ in own)), right / max(1, sum(good for _, good in own))
    return out


def told(c: Column) -> Column:
    return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def found(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans."""
    out = with_spans(docs.select("doc_id", "text"), trained(docs.sparkSession))
    count = lambda k: F.size(F.filter("_base", lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *(count(k) for k in KINDS), F.sha2(told(F.col("_base")), 256).alias("base_sha256"), told(F.col("_all")).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """The rows of docs with [KIND] for every span of their texts."""
    held = docs.select("text", F.struct(*docs.columns).alias("row"))
    out = with_spans(held, trained(docs.sparkSession))
    text = F.col("text")
    ordered = F.array_sort("_all", lambda a, b: F.when(a.start != b.start, a.start - b.start).otherwise(b.end - a.end))

    def written(x: Column) -> Column:
        """Before each span that none overlaps from the left: the text since the spans before it ended."""
        heads = F.filter(F.transform(x.spans, lambda s, i: F.struct(s.kind.alias("kind"), s.start.alias("start"), F.when(i > 0, F.get(x.reach, i - 1)).otherwise(0).alias("since"))), lambda h: h.start >= h.since)
        told = F.transform(heads, lambda h: F.concat(cut(x.chunks, h.since, h.start - h.since), F.lit("["), F.upper(h.kind), F.lit("]")))
        end = F.element_at(x.reach, -1)
        return F.concat(F.array_join(told, ""), cut(x.chunks, end, x.chars - end))

    def with_reach(spans_: Column) -> Column:
        reach = running(F.transform(spans_, lambda s: s.end), lambda a, b: F.greatest(a, b))
        return let(F.struct(spans_.alias("spans"), reach.alias("reach"), chunked(text).alias("chunks"), F.length(text).alias("chars")), written)

    clean = F.when(F.size("_all") > 0, let(ordered, with_reach)).otherwise(text)
    new = {"text": F.col("_clean"), "n_chars": F.length("_clean").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return out.select("row", clean.alias("_clean")).select(*((new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns))


def op2_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(table(spark, sf_dir, "documents"))


QUERIES = {"op2_candidate_boosting": op2_candidate_boosting}
SQL: dict[str, str] = {}
