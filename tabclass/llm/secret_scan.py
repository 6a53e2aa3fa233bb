"""Secrets in whole texts: known forms, and strings that look drawn at random.

Known forms are three patterns (assign, access, hex).  The randomness battery
adds others: every run of 20 or more key characters gets the smallest encoding
whose alphabet holds it (hex, base32, base36, base62, base64), and three tests
against draws from that alphabet: chi-squared uniformity of its symbols, number
of runs of character classes, and lag-1 serial correlation.  A string that
fails any of them has structure and is no key.

Short strings pass such tests easily, so passing isn't enough.  Each string
also gets a p-value under prose: symbols as concentrated and class changes as
rare as in the corpus's own long words, whose figures are counted over all
documents.  Strings of the same encoding and length class form a family, and in
each family the Benjamini-Hochberg rule picks those that prose explains too
badly, at a false-discovery rate of ``FDR``: in a family of short strings, where
the tests say little, none gets through.

DataFrame functions only.  One pass over the texts; the tables after it hold
spans and figures, no texts.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabclass.llm.common import pick, saved

# The known forms, in the order in which equal starts are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
KINDS = ("assign", "access", "hex", "random")

#: Runs of key characters that the battery tests.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"

# Encodings, smallest alphabet first: pattern, alphabet, and the
# shares of digits, upper-case letters, lower-case letters and signs in it.
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (
    ("hex", "^[0-9a-f]+$", "0123456789abcdef", (10, 0, 6, 0)),
    ("HEX", "^[0-9A-F]+$", "0123456789ABCDEF", (10, 6, 0, 0)),
    ("base32", "^[A-Z2-7]+$", _UPPER + "234567", (6, 26, 0, 0)),
    ("base36", "^[0-9a-z]+$", _DIGITS + _LOWER, (10, 0, 26, 0)),
    ("base62", "^[0-9A-Za-z]+$", _DIGITS + _UPPER + _LOWER, (10, 26, 26, 0)),
    ("base64", "^[0-9A-Za-z+/_-]+$", _DIGITS + _UPPER + _LOWER + "+/_-", (10, 26, 26, 2)),
)
#: Size of the alphabet (of base64's two pairs of signs, one is in use).
SIZES = {"hex": 16, "HEX": 16, "base32": 32, "base36": 36, "base62": 62, "base64": 64}

FDR = 0.01
#: A randomness test fails below this two-sided p, shared among the three tests.
ALPHA = 0.001
#: What prose looks like before any is seen, with the weight of so many symbol
#: pairs: chance that two symbols agree, and that neighbours change class.
PRIOR_AGREE, PRIOR_CHANGE, PRIOR_WEIGHT = 0.066, 0.02, 2000.0
#: p-values are counted in steps of a tenth of a decade, rounded up.
CELLS = 400

_BLOCK = 256


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _starts(gaps: Column, found: Column) -> Column:
    """Start of each match, from the texts between matches: block sums keep the
    work in proportion even if a text has very many."""
    gap = F.transform(gaps, lambda g: F.length(g))
    both = F.zip_with(F.slice(gap, F.lit(1), F.size(found)), found, lambda g, m: g + F.length(m))
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(found) / _BLOCK).cast("int")), lambda b: _sum(F.slice(both, b * _BLOCK + 1, F.lit(_BLOCK))))
    at = lambda i: _sum(F.slice(blocks, F.lit(1), F.floor(i / _BLOCK).cast("int"))) + _sum(
        F.slice(both, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK)
    )
    return F.transform(found, lambda m, i: at(i) + F.get(gap, i))


def _upper_tail(z: Column) -> Column:
    """P(normal > z) within 0.3 %, from a rational approximation."""
    x = F.abs(z)
    tail = F.exp(-x * x / 2) / 2.5066282746 / (0.661 * x + 0.339 * F.sqrt(x * x + 5.51))
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _upper_tail(F.abs(z)))


def _when(encoding: Column, values: dict[str, float]) -> Column:
    out = F.lit(None)
    for name, value in values.items():
        out = F.when(encoding == name, F.lit(value)).otherwise(out)
    return out


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _named(token: Column) -> Column:
    """A token with its encoding and that encoding's alphabet."""
    encoding, alphabet = F.lit(None).cast("string"), F.lit("")
    for name, pattern, letters, _ in reversed(ENCODINGS):
        encoding = F.when(token.rlike(pattern), F.lit(name)).otherwise(encoding)
        alphabet = F.when(token.rlike(pattern), F.lit(letters)).otherwise(alphabet)
    encoding = F.when(token.rlike("^[0-9]+$"), F.lit(None).cast("string")).otherwise(encoding)
    return F.struct(token.alias("token"), F.length(token).alias("n"), encoding.alias("enc"), alphabet.alias("alphabet"), F.split(token, "").alias("symbols"))


def _dsum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _serial(value: Column, n: Column) -> Column:
    """Lag-1 serial correlation of the symbols' places in the alphabet, cyclic."""
    turned = F.concat(F.slice(value, F.lit(2), n), F.slice(value, F.lit(1), F.lit(1)))
    total = _dsum(value)
    spread = n * _dsum(F.transform(value, lambda x: x * x)) - total * total
    return F.try_divide(n * _dsum(F.zip_with(value, turned, lambda x, y: x * y)) - total * total, spread)


def _figures(start: Column, whole: Column) -> Column:
    """Encoding and raw figures of a candidate."""

    def of(s: Column) -> Column:
        token, n = s["token"], s["n"]
        count = lambda c: (n - F.length(F.replace(token, c, F.lit("")))).cast("double")
        squares = F.aggregate(F.array_distinct(s["symbols"]), F.lit(0.0), lambda a, c: a + count(c) * count(c))
        classes = F.translate(token, _DIGITS + _UPPER + _LOWER + "+/_-", "d" * 10 + "U" * 26 + "l" * 26 + "ssss")
        changes = F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1
        places = F.transform(s["symbols"], lambda c: F.instr(s["alphabet"], c).cast("double"))
        return F.struct(
            start.alias("start"), (start + F.length(whole)).alias("end"), n.alias("n"), s["enc"].alias("enc"), squares.alias("squares"),
            changes.alias("changes"), _let(places, lambda v: _serial(v, n)).alias("serial"), token.rlike("^[A-Za-z][a-z]+$").alias("word"),
        )

    return _let(_let(F.regexp_replace(whole, "=+$", ""), _named), of)


def _random(c: Column) -> Column:
    """Whether a candidate's figures agree with draws from its alphabet."""
    n, k = c["n"].cast("double"), _when(c["enc"], {e: float(s) for e, s in SIZES.items()})
    ratio = (k / n * c["squares"] - n) / (k - 1)
    chi = (F.pow(ratio, F.lit(1 / 3)) - (1 - 2 / (9 * (k - 1)))) / F.sqrt(2 / (9 * (k - 1)))
    change = _when(c["enc"], {name: 1 - sum((s / sum(shares)) ** 2 for s in shares) for name, _, _, shares in ENCODINGS})
    runs = (c["changes"] - (n - 1) * change) / F.sqrt((n - 1) * change * (1 - change))
    serial = (c["serial"] + 1 / (n - 1)) * F.sqrt(n)
    worst = F.least(_two_sided(chi), _two_sided(runs), _two_sided(F.coalesce(serial, F.lit(99.0))))
    return F.coalesce(worst * 3 >= ALPHA, F.lit(False))


def _cell(c: Column, agree: float, change: float) -> Column:
    """Tenths of decades of the p-value under prose (a lower bound of them)."""
    n = c["n"].cast("double")
    mean = n + n * (n - 1) * agree
    var = 4 * n * (n - 1) * (n - 2) * (agree**1.5 - agree**2) + 2 * n * (n - 1) * (agree - agree**2)
    flat = _upper_tail((mean - c["squares"]) / F.sqrt(var))
    mixed = _upper_tail((c["changes"] - (n - 1) * change) / F.sqrt((n - 1) * change * (1 - change)))
    p = F.greatest(F.least(F.lit(1.0), 2 * F.least(flat, mixed)), F.lit(1e-39))
    return F.least(F.floor(-10 * F.log10(p)).cast("int"), F.lit(CELLS))


def _family(c: Column) -> Column:
    return F.concat_ws(":", c["enc"], F.floor(F.log2(c["n"].cast("double"))).cast("string"))


def discoveries(counts: dict[str, dict[int, int]], rate: float) -> dict[str, int]:
    """Benjamini-Hochberg on counted p-values: the smallest cell of each family
    from which on its strings are discoveries."""
    out = {}
    for family, cells in counts.items():
        tests, rank = sum(cells.values()), 0
        for cell in sorted(cells, reverse=True):
            rank += cells[cell]
            if 10 ** (-cell / 10) <= rate * rank / tests:
                out[family] = cell
    return out


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = FDR) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random), a row
    for every row of ``docs``.

    Spans are kind:start:end in code points, end exclusive.  A span of kind
    ``random`` never overlaps one of the base kinds.  Null texts count as empty
    and have no spans; rows that repeat an id are scanned on their own.  Other
    columns are ignored; an empty table gives an empty result.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "key": CANDIDATE}
    found = rows.select(
        "doc_id", "text", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(k) for k, p in patterns.items()],
    )
    none = F.array().cast("array<int>")
    found = found.select(
        "doc_id", *patterns, F.when(F.size("assign") > 0, F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))).alias("value"),
        *[F.when(F.size(k) > 0, _starts(F.split("text", p, -1), F.col(k))).otherwise(none).alias(f"{k}_at") for k, p in patterns.items()],
    )

    def spans(kind: str) -> Column:
        return F.zip_with(
            f"{kind}_at", kind, lambda at, m: F.struct(at.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (at + F.length(m)).alias("end"))
        )

    keep = {
        "assign": F.filter("assign_all", lambda s, i: F.length(F.get(F.col("value"), i)) >= 6),
        "access": F.filter("access_all", lambda s: s["end"] - s["start"] >= 20),
        "hex": F.col("hex_all"),
    }
    found = found.select(
        "doc_id", "value", *[spans(k).alias(f"{k}_all") for k in keep],
        F.zip_with("key_at", "key", _figures).alias("tests"),
    ).select("doc_id", "tests", *[c.alias(k) for k, c in keep.items()])
    scanned = saved(found, "secret-scan")

    tests = scanned.select(F.explode("tests").alias("t")).where("t.enc IS NOT NULL")
    words = tests.where("t.word").agg(
        F.sum(F.col("t.squares") - F.col("t.n")).alias("agree"), F.sum(F.col("t.n").cast("double") * (F.col("t.n") - 1)).alias("pairs"),
        F.sum("t.changes").alias("changes"), F.sum(F.col("t.n") - 1).alias("steps"),
    ).first()
    agree = ((words["agree"] or 0.0) + PRIOR_AGREE * PRIOR_WEIGHT) / ((words["pairs"] or 0.0) + PRIOR_WEIGHT)
    change = ((words["changes"] or 0) + PRIOR_CHANGE * PRIOR_WEIGHT) / ((words["steps"] or 0) + PRIOR_WEIGHT)
    counted: dict[str, dict[int, int]] = {}
    per_cell = tests.groupBy(_family(F.col("t")).alias("family"), _cell(F.col("t"), agree, change).alias("cell")).agg(F.count("*").alias("n"))
    for r in per_cell.collect():  # encodings x length classes x cells at most
        counted.setdefault(r["family"], {})[r["cell"]] = r["n"]
    bars = discoveries(counted, rate)

    base = F.array_sort(F.concat("assign", "access", "hex"))
    if bars:
        bar = F.create_map(*[F.lit(v) for pair in bars.items() for v in pair])
        clear = lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
        picked = F.filter("tests", lambda t: t["enc"].isNotNull() & _random(t) & (_cell(t, agree, change) >= F.coalesce(bar[_family(t)], F.lit(CELLS + 1))) & clear(t))
    else:
        picked = F.filter("tests", lambda t: F.lit(False))
    out = scanned.withColumn("base", base).withColumn("extra", F.transform(picked, lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end"))))
    names = F.array(*map(F.lit, KINDS))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    return out.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in keep], F.sha2(text(F.col("base")), 256).alias("base_sha256"),
        text(F.array_sort(F.concat("base", "extra"))).alias("spans"), F.size("extra").cast("long").alias("n_random"),
    )
