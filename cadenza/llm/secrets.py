"""Operator 5: secret scan by patterns and by a battery of randomness tests. DataFrame functions only.

Base spans, leftmost and non-overlapping for each kind, are those of three patterns with a least length:
assign, access and hex. Matches that are too short are dropped after matching.

Spans of kind ``random`` are added for runs of 20 or more of [A-Za-z0-9+/_-] outside of base spans. A long run
is judged in windows of 128 to 255 characters, so its cost is linear and no window's counts hide another's; windows that
are found side by side become one span. Two hypotheses are tested:

* random: uniform, independent characters of the window's encoding, inferred from its characters: decimal, hex (one
  case), base32, base36 (one case), or base64. Chi-squared of the characters' counts, the number of runs of
  characters in the lower or upper half of the alphabet, and the correlation of neighbours give three p-values, combined by
  Bonferroni's bound, for all windows of a run. A window that they reject at ``RANDOM_LEVEL`` (repetitions, drawn lines, counting) is no secret.
* ordinary text: neighbouring letters follow each other as they do in the corpus. The corpus's letter pairs (of all
  texts but their runs of 20 or more) give the mean and the spread of a pair's surprise;
  a window's mean surprise over its letter pairs, case folded, without steps from a small letter to a capital, gives an
  upper-tail p-value. ``SPREAD`` widens the spread, since words differ by more than independent pairs would.

The Benjamini-Yekutieli procedure over all windows of the corpus bounds the share of ordinary text among what is
reported by ``FALSE_DISCOVERY``; it is length-aware: a p-value is weighted by the window's length over the mean length. The
p-values are counted in bins of a tenth of a power of ten, so nothing is sorted or collected. A run without letters in a
row can't be told from ordinary numbers and is not reported.

A null text counts as empty. Rows with equal doc_id stay apart. An empty table gives no rows. Other
columns are ignored. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

# The kinds in their order, their patterns, the group that a match's length is of, the least length.
KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    # A run that is long enough starts where a run of any length would, so the lengths can stand in the patterns.
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
#: Cheap necessary conditions, so that only texts with a match are cut up.
PRESENT = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
    "access": r"AKIA[A-Z0-9]{14}",
    "hex": r"[0-9a-f]{16}",
    "random": r"[A-Za-z0-9+/_-]{20}",
}
RANDOM = r"[A-Za-z0-9+/_-]{20,}"
WINDOW = 128
FALSE_DISCOVERY, RANDOM_LEVEL, SPREAD = 0.05, 0.001, 2.0
LETTERS = 26
BINS_PER_POWER, MOST_POWER = 10, 300

_SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def matches(text: Column, pattern: str, group: int, least: int, kind: str, rank: int) -> Column:
    """The spans of ``pattern`` in ``text``: the lengths of the matches and of what lies between give their places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sized = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    lengths = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), lambda x: F.length(x)).alias("gap"),
        F.transform(found, lambda x: F.length(x)).alias("size"),
        F.transform(sized, lambda x: F.length(x)).alias("counted"),
    )

    def step(acc: Column, x: Column) -> Column:
        start = acc.at + x.gap
        end = start + F.coalesce(x.size, F.lit(0))  # after the last match there is only a gap
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))
        return F.struct(end.alias("at"), F.when(x.counted >= least, F.concat(acc.out, F.array(span))).otherwise(acc.out).alias("out"))

    none = F.array().cast(_SPAN)
    walk = F.aggregate(lengths, F.struct(F.lit(0).alias("at"), none.alias("out")), step)
    return F.when(text.rlike(PRESENT[kind]), walk.out).otherwise(none)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _upper_tail(z: Column) -> Column:
    """The normal distribution's upper tail, by a polynomial approximation (7.5e-8)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-F.least(z * z, F.lit(1300.0)) / 2) * 0.3989422804014327 * poly
    return F.when(z < 0, 1 - tail).otherwise(tail)


def alphabet(s: Column) -> Column:
    upper, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    return (
        F.when(s.rlike("^[0-9]+$"), digits)
        .when(s.rlike("^[0-9a-f]+$"), digits + "abcdef")
        .when(s.rlike("^[0-9A-F]+$"), digits + "ABCDEF")
        .when(s.rlike("^[A-Z2-7]*[2-7][A-Z2-7]*$"), upper + "234567")
        .when(s.rlike("^[0-9A-Z]+$"), digits + upper)
        .when(s.rlike("^[0-9a-z]+$"), digits + upper.lower())
        .when(s.rlike("[+/]"), upper + upper.lower() + digits + "+/")
        .when(s.rlike("[_-]"), upper + upper.lower() + digits + "-_")
        .otherwise(upper + upper.lower() + digits)
    )


def randomness(s: Column) -> Column:
    """The p-value of ``s`` under the hypothesis of random characters of its encoding, in one pass over them."""
    chars = F.regexp_extract_all(s, F.lit("."), F.lit(0))

    def tests(letters: Column) -> Column:
        n, kinds = F.length(s).cast("double"), F.length(letters).cast("double")
        counts = F.transform(F.sequence(F.lit(1), F.length(letters)), lambda k: F.length(s) - F.length(F.replace(s, F.substring(letters, k, F.lit(1)), F.lit(""))))
        squares = F.aggregate(counts, F.lit(0.0), lambda acc, c: acc + c * c)
        df = kinds - 1
        chi = squares * kinds / n - n
        z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        zero, none = F.lit(0.0), F.lit(None).cast("double")
        start = F.struct(zero.alias("sum"), zero.alias("square"), zero.alias("product"), zero.alias("high"), zero.alias("runs"), none.alias("first"), none.alias("last"))

        def step(acc: Column, v: Column) -> Column:
            upper = lambda x: (x > kinds / 2).cast("double")
            again = F.coalesce(acc.last, F.lit(-1.0))
            return F.struct(
                (acc.sum + v).alias("sum"),
                (acc.square + v * v).alias("square"),
                (acc.product + F.coalesce(acc.last * v, F.lit(0.0))).alias("product"),
                (acc.high + upper(v)).alias("high"),
                (acc.runs + F.when(acc.last.isNull() | (upper(again) != upper(v)), 1.0).otherwise(0.0)).alias("runs"),
                F.coalesce(acc.first, v).alias("first"),
                v.alias("last"),
            )

        def combined(a: Column) -> Column:
            product = 2 * a.high * (n - a.high)
            spread = F.sqrt(product * (product - n) / (n * n * (n - 1)))
            z_runs = F.when(spread > 0, F.abs(a.runs - product / n - 1) / spread).otherwise(F.lit(40.0))  # all in one half
            mean = a.sum / n
            variance = a.square - n * mean * mean
            together = a.product - mean * (2 * a.sum - a.first - a.last) + (n - 1) * mean * mean
            z_serial = F.when(variance > 1e-9, F.abs(together / variance + 1 / n) * F.sqrt(n)).otherwise(F.lit(40.0))
            return F.least(F.lit(1.0), 3 * F.least(_upper_tail(z_chi), 2 * _upper_tail(z_runs), 2 * _upper_tail(z_serial)))

        return let(F.aggregate(F.transform(chars, lambda c: F.instr(letters, c).cast("double")), start, step), combined)

    return let(alphabet(s), tests)


class PairModel:
    """Surprise of each pair of letters, its mean and its spread in ordinary text."""

    def __init__(self, counts: dict[str, int]):
        place = {a + b: (ord(a) - 97) * LETTERS + ord(b) - 97 for a in map(chr, range(97, 123)) for b in map(chr, range(97, 123))}
        table = [1.0] * LETTERS**2
        for pair, n in counts.items():
            table[place[pair]] += n
        rows = [sum(table[i : i + LETTERS]) for i in range(0, LETTERS**2, LETTERS)]
        self.surprise = [math.log(rows[i // LETTERS] / x) for i, x in enumerate(table)]
        total = sum(table)
        self.mean = sum(x * s for x, s in zip(table, self.surprise)) / total
        self.spread = SPREAD * max(0.1, math.sqrt(sum(x * (s - self.mean) ** 2 for x, s in zip(table, self.surprise)) / total))


def pair_counts(docs: DataFrame) -> DataFrame:
    """(pair, n): the letter pairs of all texts, without runs of 20 or more; at most 676 rows."""
    text = F.when(F.col("text").rlike(PRESENT["random"]), F.regexp_replace("text", RANDOM, " ")).otherwise(F.col("text"))
    pairs = docs.select(F.explode(F.regexp_extract_all(text, F.lit("(?=([A-Za-z][a-z]))"), F.lit(1))).alias("pair"))
    return pairs.groupBy("pair").agg(F.count("*").alias("n")).groupBy(F.lower("pair").alias("pair")).agg(F.sum("n").alias("n"))


def ordinary(s: Column, model: PairModel) -> Column:
    """The p-value of ``s`` under the hypothesis of ordinary text; 1 without letter pairs."""
    table = F.lit(model.surprise)
    start = F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("n"))

    def step(acc: Column, code: Column) -> Column:
        # codes: 65-90 and 97-122 are letters; a capital after a small letter begins a word
        letter = lambda c: c.between(65, 90) | c.between(97, 122)
        pair = letter(code) & letter(acc.before) & ~((acc.before >= 97) & (code <= 90))
        fold = lambda c: F.pmod(c - 65, F.lit(32))
        of = F.element_at(table, F.when(pair, fold(acc.before) * LETTERS + fold(code) + 1).otherwise(1))
        return F.struct(code.alias("before"), (acc.sum + F.when(pair, of).otherwise(0.0)).alias("sum"), (acc.n + F.when(pair, 1.0).otherwise(0.0)).alias("n"))

    codes = F.transform(F.regexp_extract_all(s, F.lit("."), F.lit(0)), lambda c: F.ascii(c))
    z = lambda a: (a.sum / a.n - model.mean) * F.sqrt(a.n) / model.spread
    return let(F.aggregate(codes, start, step), lambda a: F.when(a.n > 0, _upper_tail(z(a))).otherwise(1.0))


def candidates(text: Column, base: Column, model: PairModel) -> Column:
    """(start, end, p, random) of the windows of the runs outside of ``base``: both hypotheses' p-values."""
    runs = F.arrays_zip(matches(text, RANDOM, 0, 20, "random", len(KINDS)).alias("span"), F.regexp_extract_all(text, F.lit(RANDOM), F.lit(0)).alias("s"))
    outside = F.filter(runs, lambda x: ~F.exists(base, lambda b: (b.start < x.span.end) & (x.span.start < b.end)))
    cut = F.lit(f".{{{WINDOW}}}(?:.{{0,{WINDOW - 1}}}$)?|.{{1,{WINDOW - 1}}}$")

    def windows(x: Column) -> Column:
        start = lambda i: x.span.start + i * WINDOW
        judged = lambda w: F.transform(w, lambda s, i: F.struct(start(i).alias("start"), (start(i) + F.length(s)).alias("end"), ordinary(s, model).alias("p"), F.least(F.lit(1.0), randomness(s) * F.size(w)).alias("random")))
        return let(F.regexp_extract_all(x.s, cut, F.lit(0)), judged)

    return F.when(text.rlike(PRESENT["random"]), F.flatten(F.transform(outside, windows))).otherwise(F.array().cast("array<struct<start:int,end:int,p:double,random:double>>"))


def _bin(p: Column, length: Column, mean: Column) -> Column:
    """The bin of a p-value, lowered by the weight of its length."""
    weighted = p * mean / length.cast("double")
    return F.least(F.lit(BINS_PER_POWER * MOST_POWER), F.greatest(F.lit(0), F.floor(-F.log10(F.greatest(weighted, F.lit(1e-300))) * BINS_PER_POWER))).cast("int")


def _first_rejected(found: DataFrame) -> DataFrame:
    """One row: the mean length of the candidates and the first bin that is rejected (null if none is)."""
    c = found.select(F.explode("candidates").alias("c")).select((F.col("c.end") - F.col("c.start")).alias("length"), "c.p")
    mean = c.agg(F.avg("length").alias("mean"))
    bins = c.crossJoin(F.broadcast(mean)).groupBy(_bin(F.col("p"), F.col("length"), F.col("mean")).alias("bin")).agg(F.count("*").alias("n"))
    down = Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)  # at most 3001 bins
    everything = Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("n").over(everything).cast("double")
    bound = F.sum("n").over(down) * FALSE_DISCOVERY / (total * (F.log(total) + 0.5773))
    rejected = bins.select("bin", (F.pow(F.lit(10.0), -F.col("bin") / BINS_PER_POWER) <= bound).alias("small")).agg(F.min(F.when(F.col("small"), F.col("bin"))).alias("rejected"))
    return mean.crossJoin(rejected)


def joined_windows(spans: Column) -> Column:
    """Spans of kind random, those side by side as one."""

    def step(acc: Column, x: Column) -> Column:
        span = lambda start: F.struct(start.alias("start"), F.lit(len(KINDS)).alias("rank"), x.end.alias("end"), F.lit("random").alias("kind"))
        last = F.try_element_at(acc, F.lit(-1))
        return F.when(last.end == x.start, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(span(last.start)))).otherwise(F.concat(acc, F.array(span(x.start))))

    return F.aggregate(spans, F.array().cast(_SPAN), step)


def secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) of each document: arrays of (start, rank, end, kind) in order."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    model = PairModel({r.pair: r.n for r in pair_counts(docs).collect()})  # at most 676 rows
    kinds = [matches(F.col("text"), pattern, group, least, kind, rank) for rank, (kind, pattern, group, least) in enumerate(KINDS)]
    both = let(F.array_sort(F.concat(*kinds)), lambda base: F.struct(base.alias("base"), candidates(F.col("text"), base, model).alias("candidates")))
    found = written(docs.select("doc_id", both.alias("both")).select("doc_id", "both.base", "both.candidates"), "spans")
    judged = found.crossJoin(F.broadcast(_first_rejected(found)))
    secret = F.filter("candidates", lambda x: F.coalesce(_bin(x.p, x.end - x.start, F.col("mean")) >= F.col("rejected"), F.lit(False)) & (x.random >= RANDOM_LEVEL))
    return judged.select("doc_id", "base", F.array_sort(F.concat("base", joined_windows(secret))).alias("spans"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")
    found = secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *(count(k[0]) for k in KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
