"""Secret scan: fixed patterns, and a randomness test battery with false-discovery control.

The battery looks at every run of 20 or more token characters, and at the parts
of 20 or more of a run when it is cut at ``-`` and ``_``, at ``+`` and ``/``, or at
all four, so a token glued to words by separators is tested alone too. Of
accepted strings that overlap, the leftmost and then the longest counts. The encoding is
inferred from the characters, which gives an alphabet of R symbols. Three tests
ask whether the symbols look drawn at random: chi-squared against a uniform
alphabet, the number of runs above and below the alphabet's middle, and the
lag-one serial correlation. Fisher's method joins the three p-values.

Random strings have p uniform on 0 to 1, others crowd near 0, the more so the
longer they are. So strings are counted by encoding, length band and p over the
whole table. In each band the strings with p of 0.5 or more estimate how many
random ones there are; the lowest threshold stays at which at most ``fdr`` of
the strings above it are in excess of that.

Only DataFrame functions run; nothing is shuffled but the counts. Positions are
in code points, ends exclusive.

Defined results: NULL text counts as empty and has no span. Repeated rows are
scanned each. An empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, text_of

#: The base patterns, in the order in which kinds are listed; group and least length that count.
#: A run that is too short for access or hex can't match at a later start either, so their least length is in the pattern.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (("assign", ASSIGN, 2, 8), ("access", "AKIA[A-Z0-9]{12,}+", 0, 16), ("hex", "[0-9a-f]{32,}+", 0, 32))
#: Encodings in the order in which they are tried.
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (("decimal", "[0-9]+", DIGITS), ("hex", "[0-9a-f]+", DIGITS + "abcdef"), ("HEX", "[0-9A-F]+", DIGITS + "ABCDEF"),
             ("base32", "[A-Z2-7]+", UPPER + "234567"), ("base36", "[0-9a-z]+", DIGITS + LOWER),
             ("BASE36", "[0-9A-Z]+", DIGITS + UPPER), ("base62", "[0-9A-Za-z]+", DIGITS + UPPER + LOWER),
             ("base64", "[0-9A-Za-z+/]+", UPPER + LOWER + DIGITS + "+/"),
             ("base64url", "[0-9A-Za-z_-]+", UPPER + LOWER + DIGITS + "-_"),
             ("mixed", "[0-9A-Za-z+/_-]+", UPPER + LOWER + DIGITS + "+/-_"))
CANDIDATE = "[A-Za-z0-9+/_-]{20,}+"
PARTS = ("[A-Za-z0-9+/]{20,}+", "[A-Za-z0-9_-]{20,}+", "[A-Za-z0-9]{20,}+")
#: Thresholds tried, and where length bands begin.
STEPS, BANDS = (0.001, 0.003, 0.01, 0.03, 0.1, 0.2, 0.3), (20, 24, 32, 40, 48, 64, 96, 128)


def find(text: Column, pattern: str, group: int, least: int) -> Column:
    """Matches as array<struct<at, till, word>>; those whose group is shorter than ``least`` go."""
    whole, part = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    items = F.arrays_zip(F.slice(gaps, 1, F.greatest(F.size(gaps) - 1, F.lit(0))).alias("gap"), whole.alias("word"),
                         part.alias("part"))
    empty = F.array().cast("array<struct<at:int,till:int,word:string,ok:boolean>>")
    placed = F.aggregate(items, F.struct(F.lit(0).alias("now"), empty.alias("out")), lambda s, m: F.struct(
        (s["now"] + F.length(m["gap"]) + F.length(m["word"])).alias("now"),
        F.concat(s["out"], F.array(F.struct(
            (s["now"] + F.length(m["gap"])).alias("at"),
            (s["now"] + F.length(m["gap"]) + F.length(m["word"])).alias("till"), m["word"].alias("word"),
            (F.length(m["part"]) >= least).alias("ok")))).alias("out")), lambda s: s["out"])
    return F.filter(F.when(F.size(whole) == 0, empty).otherwise(placed), lambda x: x["ok"])


def _with_parts(m: Column) -> Column:
    """A run and its parts, each once."""
    def moved(x: Column) -> Column:
        return F.struct((m["at"] + x["at"]).alias("at"), (m["at"] + x["till"]).alias("till"), x["word"].alias("word"), x["ok"].alias("ok"))
    parts = F.concat(*[find(m["word"], pattern, 0, BANDS[0]) for pattern in PARTS])
    return F.when(m["word"].rlike("[+/_-]"), F.array_distinct(F.concat(F.array(m), F.transform(parts, moved)))).otherwise(F.array(m))


def _apart(spans: Column) -> Column:
    """Spans (at, till) without those that overlap a longer one from the same place or a kept one before."""
    empty = F.array().cast("array<struct<at:int,till:int>>")
    ordered = F.array_sort(F.transform(spans, lambda m: F.struct(m["at"].alias("at"), (-m["till"]).alias("back"))))
    return F.aggregate(ordered, F.struct(F.lit(0).alias("till"), empty.alias("out")), lambda s, m: F.struct(
        F.greatest(s["till"], -m["back"]).alias("till"),
        F.when(m["at"] < s["till"], s["out"]).otherwise(F.concat(s["out"], F.array(F.struct(
            m["at"].alias("at"), (-m["back"]).alias("till"))))).alias("out")), lambda s: s["out"])


def _upper_tail(z: Column) -> Column:
    """1 - Phi(z), within 0.0002."""
    z = F.least(F.greatest(z, F.lit(-8.0)), F.lit(8.0))
    return 1.0 / (1.0 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def _battery(word: Column) -> Column:
    """struct<encoding, p>."""
    choice = F.lit(None).cast("int")
    for i in reversed(range(len(ENCODINGS))):
        choice = F.when(word.rlike(f"^{ENCODINGS[i][1]}$"), i).otherwise(choice)
    alphabets = F.array(*[F.lit(a) for _, _, a in ENCODINGS])

    def tests(w: Column) -> Column:
        def with_symbols(k: Column) -> Column:
            alphabet = F.get(alphabets, k)
            xs = F.transform(F.filter(F.split(w, ""), lambda c: c != ""),
                             lambda c: (F.call_function("instr", alphabet, c) - 1).cast("double"))
            counts = F.transform(F.split(alphabet, ""), lambda c: (
                F.length(w) - F.length(F.call_function("replace", w, c, F.lit("")))).cast("double"))
            squares = F.aggregate(F.filter(counts, lambda c: c > 0), F.lit(0.0), lambda a, c: a + c * c)
            return F.struct(k.alias("k"), xs.alias("xs"), F.length(alphabet).cast("double").alias("r"),
                            F.length(w).cast("double").alias("n"), squares.alias("squares"),
                            F.aggregate(xs, F.lit(0.0), lambda a, x: a + x).alias("total"))
        return F.transform(F.filter(F.array(choice), lambda k: k.isNotNull()), with_symbols)

    def sums(s: Column) -> Column:
        mean, half = s["total"] / s["n"], (s["r"] - 1) / 2
        pairs = F.arrays_zip(F.slice(s["xs"], 1, F.size(s["xs"]) - 1).alias("a"), F.slice(s["xs"], 2, F.size(s["xs"])).alias("b"))
        return F.struct(
            s["k"].alias("k"), s["r"].alias("r"), s["n"].alias("n"), s["squares"].alias("squares"),
            F.aggregate(s["xs"], F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)).alias("spread"),
            F.aggregate(pairs, F.lit(0.0), lambda a, x: a + (x["a"] - mean) * (x["b"] - mean)).alias("lagged"),
            F.aggregate(pairs, F.lit(1.0), lambda a, x: a + F.when((x["a"] > half) != (x["b"] > half), 1.0).otherwise(0.0)).alias("runs"),
            F.aggregate(s["xs"], F.lit(0.0), lambda a, x: a + F.when(x > half, 1.0).otherwise(0.0)).alias("high"))

    def join(s: Column) -> Column:
        n, r = s["n"], s["r"]
        chi = (r * s["squares"] / n - n - (r - 1)) / F.sqrt(2 * (r - 1) * (n - 1) / n)
        mean_runs = 2 * s["high"] * (n - s["high"]) / n + 1
        var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
        runs = F.when(var_runs > 0, F.abs(s["runs"] - mean_runs) / F.sqrt(F.greatest(var_runs, F.lit(1e-9)))).otherwise(8.0)
        serial = F.when(s["spread"] > 0, F.abs(s["lagged"] / F.greatest(s["spread"], F.lit(1e-9)) + 1 / n) * F.sqrt(n)).otherwise(8.0)
        logs = sum((F.log(F.greatest(p, F.lit(1e-15))) for p in (
            _upper_tail(chi), F.least(F.lit(1.0), 2 * _upper_tail(runs)), F.least(F.lit(1.0), 2 * _upper_tail(serial)))), F.lit(0.0))
        half = -logs  # half of Fisher's statistic; its tail at 6 degrees of freedom
        return F.struct(s["k"].alias("encoding"), (F.exp(-half) * (1 + half + half * half / 2)).alias("p"))

    return F.get(F.transform(F.transform(tests(word), sums), join), F.lit(0))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, base spans and battery candidates (at, till, encoding, band, p) of every row; a written table."""
    text = text_of(text_col)
    band = lambda n: sum(((n >= b).cast("int") for b in BANDS), F.lit(-1))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    columns = {kind: find(F.col("text"), pattern, group, least) for kind, pattern, group, least in BASE}
    columns["runs"] = find(F.col("text"), CANDIDATE, 0, BANDS[0])
    found = rows.withColumns(columns).withColumn("runs", F.flatten(F.transform("runs", _with_parts)))
    tested = F.transform("runs", lambda m: F.struct(
        m["at"].alias("at"), m["till"].alias("till"), band(m["till"] - m["at"]).alias("band"), _battery(m["word"]).alias("test")))
    spans = [F.transform(kind, lambda m: F.struct(m["at"].alias("at"), m["till"].alias("till"))).alias(kind) for kind, *_ in BASE]
    return stage(found.select("id", *spans, tested.alias("tested")), "secret-scan")


def thresholds(scanned: DataFrame, fdr: float) -> dict[tuple[int, int], float]:
    """Least p that passes, per (encoding, band); a table bounded by encodings, bands and steps."""
    t = F.col("t")
    above = [F.sum((t.test.p >= s).cast("int")).alias(f"n{i}") for i, s in enumerate((*STEPS, 0.5))]
    counts = (scanned.select(F.explode("tested").alias("t")).filter(t.test.encoding.isNotNull())
              .groupBy(t.test.encoding.alias("encoding"), t.band.alias("band")).agg(*above)).collect()
    chosen = {}
    for row in counts:
        true = row[f"n{len(STEPS)}"] / 0.5
        for i, s in enumerate(STEPS):
            n = row[f"n{i}"]
            if n and max(0.0, n - true * (1 - s)) <= fdr * n:
                chosen[row.encoding, row.band] = s
                break
    return chosen


def secrets(docs: DataFrame, fdr: float = 0.05, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_assign, n_access, n_hex, n_random, base_sha256, spans."""
    scanned = scan(docs, id_col, text_col)
    passed = thresholds(scanned, fdr)
    kinds = [kind for kind, *_ in BASE]
    tag = lambda kind, rank: F.transform(kind, lambda m: F.struct(
        m["at"].alias("at"), F.lit(rank).alias("rank"), m["till"].alias("till"), F.lit(kind).alias("kind")))
    base = F.concat(*[tag(kind, i) for i, kind in enumerate(kinds)])
    limit = F.lit(2.0)
    if passed:
        table = F.create_map(*[x for (e, b), s in sorted(passed.items()) for x in (F.lit(e * 100 + b), F.lit(s))])
        accept = lambda m: F.coalesce(m["test"]["p"] >= F.element_at(table, m["test"]["encoding"] * 100 + m["band"]), F.lit(False))
    else:
        accept = lambda m: m["test"]["p"] >= limit
    clear = lambda m: accept(m) & ~F.exists("base", lambda b: (b["at"] < m["till"]) & (m["at"] < b["till"]))
    more = F.transform(_apart(F.filter("tested", clear)), lambda m: F.struct(
        m["at"].alias("at"), F.lit(len(kinds)).alias("rank"), m["till"].alias("till"), F.lit("random").alias("kind")))
    line = lambda spans: F.array_join(F.transform(F.sort_array(spans), lambda m: F.concat_ws(
        ":", m["kind"], m["at"].cast("string"), m["till"].cast("string"))), ",")
    return (scanned.withColumn("base", base).withColumn("random", more).select(
        "id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in kinds], F.size("random").cast("long").alias("n_random"),
        F.sha2(line(F.col("base")), 256).alias("base_sha256"), line(F.concat("base", "random")).alias("spans")))
