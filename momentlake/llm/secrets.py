"""Secret scans: pattern spans, plus strings that pass a battery of randomness tests.

Built-in functions only.  A candidate is a long run of encoding characters whose encoding can be
inferred; ``=`` ends a run, and of a run that has no encoding the parts between separators are tried.  Three tests take
"its symbols are independent and uniform" as their hypothesis: chi-squared counts over the alphabet, runs above and
below the middle of the alphabet, and lag-one serial correlation.  Fisher's method makes one p-value.  Strings too short to
count every symbol are counted in four groups of them, from the symbols that words are made of most to the rarest, so that
ordinary names, which are made of few letters, stand out.

Secrets are the discoveries: strings whose randomness the battery does not reject.  Their p-values are even from 0 to 1, while those of
ordinary strings crowd near 0, so what lies in the upper half tells how many secrets a length class holds, and the limit of the
class is the least one above which all but the allowed share is accounted for by them.  Short strings, for which the tests
have less power, are judged against short ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from momentlake.llm.common import boxed

#: Fixed patterns and least lengths of the base kinds, in their order.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_ASSIGN = 6
KINDS = ("assign", "access", "hex", "random")

#: Encodings by the pattern their strings match, the narrowest first, and their alphabets in order of value.
ENCODINGS = (
    ("hex", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", "0123456789abcdef"),
    ("hex upper", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64 url", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
#: Characters of a candidate at least, padding among them.
LEAST_RANDOM = 20


def _candidates() -> str:
    """Pattern of the runs with a known encoding: whole runs first, then parts between ``/`` and ``+``, between ``_`` and ``-``, and between all four.

    A part with ``/`` or ``+`` in it gives way to a long stretch of letters and digits behind one of them: a path before a key.
    """
    upper, lower, digit = "(?=[{0}]*[A-Z])", "(?=[{0}]*[a-z])", "(?=[{0}]*[0-9])"
    plain = [("0-9a-f", digit + "(?=[{0}]*[a-f])"), ("0-9A-F", digit + "(?=[{0}]*[A-F])"), ("A-Z2-7", "(?=[{0}]*[2-7])" + upper), ("a-z0-9", digit + lower)]
    either = digit + lower + upper
    base64, url, mixed = ("A-Za-z0-9+/", either), ("A-Za-z0-9_-", either), ("A-Za-z0-9", either)
    path = f"(?![A-Za-z0-9+/]*[+/][A-Za-z0-9]{{{LEAST_RANDOM}}})"
    levels = (
        ("A-Za-z0-9+/_-", "", [*plain, base64, url]),
        ("A-Za-z0-9_-", "", [*plain, url]),
        ("A-Za-z0-9+/", path, [*plain, base64]),
        ("A-Za-z0-9", "", [*plain, mixed]),
    )

    def run(letters: str) -> str:
        padded = [f"[{letters}]{{{LEAST_RANDOM - n}}}(?=={{{n}}})" for n in range(1, 7)]
        return "(?:" + "|".join([f"[{letters}]{{{LEAST_RANDOM},}}+", *padded]) + ")"

    found = [
        f"(?<![{bounds}]){unless}(?:" + "|".join(f"{needs.format(letters)}{run(letters)}(?![{bounds}])" for letters, needs in encodings) + ")"
        for bounds, unless, encodings in levels
    ]
    # Every run begins where no letter or digit stands before.
    return f"(?<![A-Za-z0-9])(?=[A-Za-z0-9+/_=-]{{{LEAST_RANDOM}}})(?:" + "|".join(found) + ")=*+"


CANDIDATE = _candidates()
#: Symbols in the order in which words use them, letters of either case and the rest after the common ones.
_COMMON = "etaoinsrhldcumfpgwybvkxjqz"
#: Groups in which symbols are counted, and the expected count from which on each symbol is counted by itself.
GROUPS, LEAST_EXPECTED = 4, 5
#: Allowed share of ordinary strings among the secrets, and the bins in which p-values are counted (per decade).
FDR, BINS_PER_DECADE, MOST_DECADES = 0.05, 20, 300
#: Bins of the p-values that are never random (at most 10^-1.6, about 0.025), and of the upper half.
LEVEL_BIN, UPPER_BIN = 32, 6
_BLOCK = 128
_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _located(text: str, pattern: str) -> Column:
    """(start, end, match) of all matches, code points from 0, end exclusive.

    The pieces between matches and the matches give the lengths; sums run over blocks, so that a
    text with very many matches takes no quadratic time.
    """
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    gaps = F.split(F.col(text), pattern, -1)
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("len"), m.alias("match")))

    def spans(steps: Column) -> Column:
        lens = F.transform(steps, lambda s: s["gap"] + s["len"])
        sums = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int")), lambda b: _sum(F.slice(lens, b * _BLOCK + 1, _BLOCK)))

        def one(s: Column, i: Column) -> Column:
            block = F.floor(i / _BLOCK).cast("int")
            start = _sum(F.slice(sums, F.lit(1), block)) + _sum(F.slice(lens, block * _BLOCK + 1, i - block * _BLOCK)) + s["gap"]
            return F.struct(start.alias("start"), (start + s["len"]).alias("end"), s["match"].alias("match"))

        return F.transform(steps, one)

    return F.when(F.regexp_like(F.col(text), F.lit(pattern)), F.element_at(F.transform(F.array(steps), spans), 1))


def _spans(located: Column, kind: int, keep=None) -> Column:
    kept = located if keep is None else F.filter(located, keep)
    made = F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))
    return F.coalesce(made, F.array().cast(_SPANS))


def with_base_spans(rows: DataFrame) -> DataFrame:
    """Add ``_assign``, ``_access`` and ``_hex``, the base spans of the column ``_t``."""
    long_value = lambda m: F.length(F.regexp_extract(m["match"], ASSIGN, 2)) >= LEAST_ASSIGN
    either = F.contains("_t", F.lit("=")) | F.contains("_t", F.lit(":"))
    return (
        rows.withColumn("_assign", _spans(F.when(either, _located("_t", ASSIGN)), 0, long_value))
        .withColumn("_access", _spans(F.when(F.contains("_t", F.lit("AKIA")), _located("_t", ACCESS)), 1))
        .withColumn("_hex", _spans(_located("_t", HEX), 2))
    )


def _alphabet(s: Column) -> Column:
    out = None
    for _, pattern, letters in ENCODINGS:
        hit = F.regexp_like(s, F.lit(pattern))
        out = F.when(hit, F.lit(letters)) if out is None else out.when(hit, F.lit(letters))
    return out


def _upper_tail(z: Column) -> Column:
    """Upper tail of the normal distribution (Abramowitz and Stegun 26.2.17)."""
    x = F.least(F.abs(z), F.lit(37.0))
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.greatest(F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * poly, F.lit(1e-290))
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _add(column: Column) -> Column:
    return F.aggregate(column, F.lit(0.0), lambda a, v: a + v)


def _pairs(m: Column, field: str, fn) -> Column:
    n = m["length"]
    return _add(F.zip_with(F.slice(m[field], F.lit(1), n - 1), F.slice(m[field], F.lit(2), n), fn))


def _by_use(letters: str) -> str:
    """An alphabet from the symbols that words use most to the others."""
    common = [c for c in _COMMON + _COMMON.upper() if c in letters]
    return "".join(common) + "".join(c for c in letters if c not in common)


def _ranked(m: Column) -> Column:
    pairs = [F.lit(x) for letters in {e[2] for e in ENCODINGS} for x in (letters, _by_use(letters))]
    return F.element_at(F.create_map(*pairs), m["letters"])


def _deviate(squares: Column, n: Column, cells: Column) -> Column:
    """Chi-squared of counts in equal cells, from the sum of their squares, as a normal deviate (Wilson-Hilferty)."""
    spread = 2 / (9 * (cells - 1))
    ratio = F.greatest(cells / n * squares - n, F.lit(0.0)) / (cells - 1)
    return (F.pow(ratio, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)


def _chi2_z(m: Column) -> Column:
    """Uniformity over the symbols of a long string, over groups of them in a short one."""
    n, letters = m["length"].cast("double"), F.length(m["letters"]).cast("double")
    squares = _add(F.transform(F.array_distinct(m["c"]), lambda c: F.pow(n - F.length(F.replace(m["s"], c, F.lit(""))), F.lit(2.0))))
    # Every alphabet has a multiple of GROUPS symbols.
    within = lambda j: lambda c: F.floor((F.instr(m["ranked"], c) - 1) * GROUPS / letters) == j
    counts = [F.size(F.filter(m["c"], within(j))).cast("double") for j in range(GROUPS)]
    grouped = sum((c * c for c in counts), F.lit(0.0))
    return F.when(n >= LEAST_EXPECTED * letters, _deviate(squares, n, letters)).otherwise(_deviate(grouped, n, F.lit(float(GROUPS))))


def _runs_z(m: Column) -> Column:
    n = m["length"].cast("double")
    cross = 2 * m["ones"] * (n - m["ones"])
    variance = cross * (cross - n) / (n * n * (n - 1))
    runs = 1 + _pairs(m, "high", lambda a, b: F.abs(a - b))
    return F.when(variance > 0, (runs - cross / n - 1) / F.sqrt(variance)).otherwise(F.lit(37.0))


def _serial_z(m: Column) -> Column:
    n = m["length"].cast("double")
    spread = _add(F.transform(m["x"], lambda x: (x - m["mean"]) * (x - m["mean"])))
    lagged = _pairs(m, "x", lambda a, b: (a - m["mean"]) * (b - m["mean"]))
    return F.when(spread > 0, (lagged / spread + 1 / n) * F.sqrt(n)).otherwise(F.lit(37.0))


def _fisher(m: Column) -> Column:
    """One p-value of three: the upper tail of chi-squared with six degrees of freedom."""
    two_sided = lambda z: F.least(2 * _upper_tail(F.abs(z)), F.lit(1.0))
    return -(F.ln(_upper_tail(m["z1"])) + F.ln(two_sided(m["z2"])) + F.ln(two_sided(m["z3"])))


#: Fields added to a candidate one after the other, each from those before it.
_BATTERY = (
    ("letters", lambda m: _alphabet(m["match"])),
    ("ranked", _ranked),
    ("s", lambda m: F.rtrim(m["match"], F.lit("="))),
    ("c", lambda m: F.split(m["s"], "")),
    ("length", lambda m: F.size(m["c"])),
    ("x", lambda m: F.transform(m["c"], lambda c: (F.instr(m["letters"], c) - 1).cast("double"))),
    ("high", lambda m: F.transform(m["x"], lambda x: (x * 2 >= F.length(m["letters"])).cast("double"))),
    ("ones", lambda m: _add(m["high"])),
    ("mean", lambda m: _add(m["x"]) / m["length"]),
    ("z1", _chi2_z),
    ("z2", _runs_z),
    ("z3", _serial_z),
    ("half", _fisher),
    ("p", lambda m: F.greatest(F.exp(-m["half"]) * (1 + m["half"] + m["half"] * m["half"] / 2), F.lit(10.0**-MOST_DECADES))),
)


def _adding(name: str, fn):
    return lambda m: m.withField(name, fn(m))


def with_candidates(rows: DataFrame) -> DataFrame:
    """Add ``_m``: start, end, length and p-value of each candidate in ``_t`` whose encoding is known."""
    rows = rows.withColumn("_m", _located("_t", CANDIDATE))
    for name, fn in _BATTERY:
        rows = rows.withColumn("_m", F.transform("_m", _adding(name, fn)))
        if name == "letters":
            rows = rows.withColumn("_m", F.filter("_m", lambda m: m["letters"].isNotNull()))
    slim = F.transform("_m", lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["length"].alias("length"), m["p"].alias("p")))
    return rows.withColumn("_m", slim)


def _length_class(length: Column) -> Column:
    return F.floor(F.log2(length.cast("double")) * 2).cast("int")


def random_limits(rows: DataFrame, rate: float = FDR) -> dict[int, float]:
    """Per length class the p-value above which a candidate is random; a class without one has no secrets.

    P-values of the whole corpus are counted in bins; the table is bounded by length classes x bins.
    """
    one = with_candidates(rows).select(F.explode("_m").alias("m"))
    binned = one.select(
        _length_class(F.col("m.length")).alias("class"), F.floor(-F.log10("m.p") * BINS_PER_DECADE).cast("int").alias("bin")
    )
    counts = binned.where(F.col("bin") < LEVEL_BIN).groupBy("class", "bin").agg(F.count("*").alias("n")).collect()
    by_class: dict[int, dict[int, int]] = {}
    for r in counts:
        by_class.setdefault(r["class"], {})[r["bin"]] = r["n"]
    return {c: limit for c, bins in by_class.items() if (limit := class_limit(bins, rate)) is not None}


def class_limit(bins: dict[int, int], rate: float) -> float | None:
    """The least edge of a bin above which at most ``rate`` of the p-values are more than an even spread of secrets."""
    edge = lambda b: 10.0 ** (-b / BINS_PER_DECADE)
    above = lambda b: sum(n for at, n in bins.items() if at < b)
    secrets = (above(UPPER_BIN) + 1) / (1 - edge(UPPER_BIN))
    for b in range(LEVEL_BIN, 0, -1):
        if above(b) and 1 - secrets * (1 - edge(b)) / above(b) <= rate:
            return edge(b)
    return None


def find_secrets(docs: DataFrame, *, rate: float = FDR) -> DataFrame:
    """``docs`` with ``spans`` (array of start, kind, end; kind is an index into ``KINDS``) and
    ``n_assign``, ``n_access``, ``n_hex``, ``n_random``.

    Spans count code points of the whole text, by start, then kind.  Base spans are the fixed
    patterns'; a random span is added where it meets none of them.  Null and empty texts have no
    spans; repeated rows are scanned each; columns with the names of the result (and ``base``, the fixed
    patterns' spans) are replaced; very long texts are scanned whole; an empty table gives an empty result.
    """
    made = ["base", "spans", *[f"n_{k}" for k in KINDS]]
    rows = boxed(docs, F.coalesce("text", F.lit("")).alias("_t"), without=made)
    limits = random_limits(rows.select("_t"), rate)
    rows = with_base_spans(rows).withColumn("_base", F.concat("_assign", "_access", "_hex"))
    rows = with_candidates(rows)
    rows = rows.withColumn("_random", _random_spans(limits))
    counts = [F.size(f"_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS]
    return rows.select("box.*", F.col("_base").alias("base"), F.array_sort(F.concat("_base", "_random")).alias("spans"), *counts)


def _random_spans(limits: dict[int, float]) -> Column:
    """The candidates whose p-value lies above the limit of their length class and that meet no base span."""
    table = F.create_map(*[F.lit(x) for pair in sorted(limits.items()) for x in pair]) if limits else None

    def random(m: Column) -> Column:
        edge = F.coalesce(F.element_at(table, _length_class(m["length"])), F.lit(1.0)) if limits else F.lit(1.0)
        meets = F.exists("_base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
        return (m["p"] > edge) & ~meets

    return _spans(F.col("_m"), 3, random)


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
