"""Secrets in texts: patterns, and a battery of randomness tests on long tokens with control of false dismissals.

Three patterns give the base spans. The method's spans (``random``) are tokens of 20 or more characters that pass for random
data. A token's encoding is the smallest alphabet that holds it; under the hypothesis that its characters are drawn from that
alphabet at random, four statistics get a p-value: chi-squared over the characters and over their classes (digits, upper and lower case,
signs), the runs above and below the middle of the alphabet, and the serial correlation of neighbours. They are combined by
Bonferroni's bound. The procedure of Benjamini and Hochberg, over all tokens of the corpus of one encoding and length class,
dismisses what is structured, so that of the dismissed tokens at most the class's share ``LEVELS`` is expected to be random; short
tokens, on which tests have little power, have a larger share. All tokens that are left are reported.

Only built-in functions run: texts are scanned once for the tokens' p-values, of which only counts by class and bin are
shuffled (a table of bounded size), and once for the spans; rows stay where they are. Positions come from a prefix
scan over the lengths between matches, so that a text with many matches costs n log n.

Defined results: null text counts as empty and has no spans; repeated rows are scanned alike, and each of their tokens counts as
a test; texts of any length are read whole; ties in p fall on one side; an empty table gives an empty result; other columns
are kept as they are (a column named as the result's raises a ValueError).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

KEYWORDS = "password|passwd|secret|token|api_?key"
#: kind -> (pattern, group whose length counts, least length), in the order of the contract (fixed values).
BASE = {
    "assign": (rf"""((?i:{KEYWORDS}))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
RANDOM = "random"
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Encodings from the smallest alphabet on: characters in their order.
ENCODINGS = (
    _DIGITS + "abcdef",
    _DIGITS + "ABCDEF",
    _UPPER + "234567",
    _DIGITS + _UPPER,
    _DIGITS + _LOWER,
    _DIGITS + _UPPER + _LOWER,
    _UPPER + _LOWER + _DIGITS + "+/",
    _UPPER + _LOWER + _DIGITS + "-_",
    _UPPER + _LOWER + _DIGITS + "+/-_",
)
#: Length classes (lower ends) and the share of random tokens that may be among the dismissed ones.
LEVELS = ((20, 0.05), (24, 0.04), (32, 0.02), (48, 0.01), (96, 0.005))
#: p-values are held by bins of a quarter power of two, down to 2^-32.
BINS = 128
_TESTS = 4


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """An expression in which a value stands many times and is computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def prefix_sums(numbers: Column) -> Column:
    """Inclusive sums of an array, by doubling."""
    n = F.size(numbers)

    def doubled(sums: Column, power: Column) -> Column:
        by = F.pow(F.lit(2), power).cast("int")
        return F.zip_with(sums, F.concat(F.array_repeat(F.lit(0).cast("long"), by), F.slice(sums, F.lit(1), F.greatest(n - by, F.lit(0)))), lambda a, b: a + F.coalesce(b, F.lit(0).cast("long")))

    steps = F.when(n > 1, F.sequence(F.lit(0), F.ceil(F.log2(n)).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, numbers, lambda sums, power: F.slice(doubled(sums, power), F.lit(1), n))


def places(text: Column, pattern: str) -> Column:
    """Array of struct(start, end, found): the leftmost non-overlapping matches, in code points."""
    regex = F.lit(pattern)
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, regex, F.lit(0))
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, f: (F.char_length(g) + F.char_length(f)).cast("long"))
    ended = F.zip_with(prefix_sums(steps), found, lambda end, f: F.struct((end - F.char_length(f)).alias("start"), end.alias("end"), f.alias("found")))
    none = F.array().cast("array<struct<start:bigint,end:bigint,found:string>>")
    return F.when(text.rlike(pattern), ended).otherwise(none)


def _spans(found: Column, nth: int, kind: str) -> Column:
    return F.transform(found, lambda s: F.struct(s["start"], F.lit(nth).alias("nth"), s["end"], F.lit(kind).alias("kind")))


def base_spans(text: Column) -> Column:
    """Array of struct(start, nth, end, kind): ``nth`` is the kind's place in ``BASE``."""
    def of_kind(nth: int, kind: str) -> Column:
        pattern, group, least = BASE[kind]
        counted = lambda s: F.regexp_extract(s["found"], pattern, group) if group else s["found"]
        kept = F.filter(places(text, pattern), lambda s: F.char_length(counted(s)) >= least)
        return _spans(kept, nth, kind)

    return F.concat(*[of_kind(nth, kind) for nth, kind in enumerate(BASE)])


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal variable, with the closed approximation of Karagiannidis and Lioumpas (2007)."""
    x = F.greatest(F.least(F.abs(z), F.lit(12.0)), F.lit(1e-9))
    tail = (1 - F.exp(-1.4 * x)) * F.exp(-x * x / 2) / (1.135 * math.sqrt(2 * math.pi) * x)
    return F.when(z >= 0, tail).otherwise(1 - tail)


def chi_squared_tail(x: Column, df: Column) -> Column:
    """P(X > x) by the cube root of Wilson and Hilferty."""
    return upper_tail((F.pow(x / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))


def _classes(alphabet: str) -> list[int]:
    return [sum(c in group for c in alphabet) for group in (_DIGITS, _UPPER, _LOWER, "+/-_")]


def encoding(token: Column) -> Column:
    """struct(no, alphabet, halves, sizes) of the smallest alphabet that holds a token."""
    out = None
    for no, alphabet in enumerate(ENCODINGS):
        half = len(alphabet) // 2
        sizes = F.array(*map(F.lit, _classes(alphabet)))
        made = F.struct(F.lit(no).alias("no"), F.lit(alphabet).alias("alphabet"), F.lit("0" * half + "1" * half).alias("halves"), sizes.alias("sizes"))
        holds = token.rlike("^[" + alphabet.replace("-", r"\-") + "]+$")
        out = F.when(holds, made) if out is None else out.when(holds, made)
    return out


def p_value(token: Column, code: Column) -> Column:
    """The combined p-value of a token under its encoding."""
    n, k = F.char_length(token).cast("double"), F.char_length(code["alphabet"]).cast("double")
    count = lambda text, c: F.char_length(text) - F.char_length(F.replace(text, c, F.lit("")))
    squares = F.aggregate(F.regexp_extract_all(code["alphabet"], F.lit("."), F.lit(0)), F.lit(0.0), lambda sum_, c: sum_ + F.pow(count(token, c).cast("double"), F.lit(2.0)))
    cells = chi_squared_tail(F.greatest(squares * k / n - n, F.lit(0.0)), k - 1)
    seen = F.array(*[(n - F.char_length(F.regexp_replace(token, c, ""))) for c in ("[0-9]", "[A-Z]", "[a-z]", "[+/_-]")])
    classes = F.zip_with(seen, code["sizes"], lambda o, s: F.when(s > 0, F.pow(o - n * s / k, F.lit(2.0)) / (n * s / k)).otherwise(0.0))
    degrees = F.size(F.filter(code["sizes"], lambda s: s > 0)) - 1
    by_class = chi_squared_tail(F.aggregate(classes, F.lit(0.0), lambda a, b: a + b), degrees.cast("double"))
    halves = F.call_function("translate", token, code["alphabet"], code["halves"])
    turns = (count(halves, F.lit("01")) + count(halves, F.lit("10"))) / 2
    runs = 2 * upper_tail(F.abs(turns - (n - 1) / 2) / F.sqrt((n - 1) / 4))
    values = F.transform(F.regexp_extract_all(token, F.lit("."), F.lit(0)), lambda c: 2 * (F.position(c, code["alphabet"]) - 1) - (k - 1))
    products = let(values, lambda v: F.aggregate(F.zip_with(F.slice(v, F.lit(1), F.size(v) - 1), F.slice(v, F.lit(2), F.size(v) - 1), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x))
    # The doubled values have variance (k^2 - 1) / 3.
    serial = 2 * upper_tail(F.abs(products) / (F.sqrt(n - 1) * (k * k - 1) / 3))
    return F.least(F.lit(1.0), _TESTS * F.least(cells, by_class, runs, serial))


def tested(token: Column) -> Column:
    """struct(class, bin) of a token: its encoding and length class, and the bin of its p-value (large bins, small p)."""
    n = F.char_length(token)
    length = sum((F.when(n >= low, 1).otherwise(0) for low, _ in LEVELS[1:]), F.lit(0))
    bin_of = lambda p: F.least(F.lit(BINS), F.floor(-4 * F.log2(p)).cast("int"))
    return let(encoding(token), lambda code: F.struct((code["no"] * len(LEVELS) + length).alias("class"), bin_of(p_value(token, code)).alias("bin")))


def dismissals(docs: DataFrame, text: str) -> dict[int, int]:
    """Per class of tokens the bin from which on p-values are dismissed: Benjamini and Hochberg over all tokens of all texts."""
    whole = F.col(text).cast("string")
    tokens = docs.where(whole.rlike(TOKEN)).select(F.explode(F.regexp_extract_all(whole, F.lit(TOKEN), F.lit(0))).alias("token"))
    counts = tokens.select(tested(F.col("token")).alias("t")).groupBy("t.class", "t.bin").count()
    held: dict[int, dict[int, int]] = {}
    for r in counts.collect():  # at most encodings x lengths x bins rows
        held.setdefault(r["class"], {})[r["bin"]] = r["count"]
    out = {}
    for name, found in held.items():
        level, total, rejected = LEVELS[name % len(LEVELS)][1], sum(found.values()), 0
        for b in sorted(found, reverse=True):
            rejected += found[b]
            if 2 ** (-b / 4) * total <= level * rejected:
                out[name] = b
    return out


def random_spans(text: Column, dismissed: dict[int, int]) -> Column:
    """Array of struct(start, nth, end, kind) of the tokens that are not dismissed."""
    limits = F.create_map(*[F.lit(v) for pair in dismissed.items() for v in pair]) if dismissed else F.create_map().cast("map<int,int>")
    left = lambda t: t["bin"] < F.coalesce(F.try_element_at(limits, t["class"]), F.lit(BINS + 1))
    kept = F.filter(places(text, TOKEN), lambda s: left(tested(s["found"])))
    return _spans(kept, len(BASE), RANDOM)


def joined(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, text: str = "text", result: str = "secrets") -> DataFrame:
    """The rows with ``secrets``: array of struct(start, nth, end, kind), in that order. Calling it scans for p-values."""
    if fresh(docs, result) != [result]:
        raise ValueError(f"there is a column {result} already")
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.withColumn(result, F.sort_array(F.concat(base_spans(whole), random_spans(whole, dismissals(docs, text)))))


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_assign, n_access, n_hex, base_sha256, spans and n_random of every row."""
    found = scan(docs.select(F.col(key).alias("key"), F.col(text).alias("text")))
    number = lambda nth: F.size(F.filter("secrets", lambda s: s["nth"] == nth)).cast("long")
    counts = [number(nth).alias(f"n_{kind}") for nth, kind in enumerate([*BASE, RANDOM])]
    base = F.sha2(joined(F.filter("secrets", lambda s: s["nth"] < len(BASE))), 256).alias("base_sha256")
    return found.select(F.col("key").alias(key), *counts, base, joined(F.col("secrets")).alias("spans"))
