"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

One pattern finds the candidates of a text. Each is validated for its kind: card
numbers by their check digit, social security numbers, addresses and dates by
the ranges of their parts. A valid value becomes a number in a product of two
ranges, and ten alternating Feistel rounds with SHA-256 permute that product, so
the map is one to one and equal values stay equal in every document. The new
number is written in the old one's format: same separators, a right check digit,
a real date. The local part of a mail address is permuted character by character
(letters and digits stay what they are), its domain stays. With the same key,
``invert=True`` restores the text.

Only DataFrame functions run, in one pass without a shuffle.

Formats: cards of 13 to 19 digits; ddd-dd-dddd; IPv4; yyyy-mm-dd, yyyy/mm/dd,
dd.mm.yyyy and dd/mm/yyyy between 1900-01-01 and 2079-06-05, and mm/dd/yyyy where
it can't be dd/mm/yyyy (then the new day is over 12 too); phone numbers in
the North American form (the last ten digits change, so a country code stays).

In digit groups joined by single spaces or hyphens, a card is whole groups with a
right check digit. Groups in the form of a card (``LAYOUTS``, one separator
throughout) come first, form by form and from the left; what they leave is
searched for other groups of 13 to 19 digits, from the left and fewest first. So
the choice does not depend on numbers beside a card in such a form, and its
pseudonym is the same there as alone. The one exception are further groups of
four right before it, joined by the same separator: where new digits make those
and the card's first groups a card themselves, the cards of the run are permuted
again, which keeps the inverse exact, and get other pseudonyms than alone.

Defined results: NULL text stays NULL and has no match. What fails its
validation stays as it is. Repeated rows are treated alike. An empty table gives
an empty result. ``pseudonymise`` adds its counts as one struct column under the
name given, after the documents' own columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: what ends a run of digit groups, as it is of another kind.
OTHER = (r"\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)|(?<!-)\d{4}(?:-\d\d-|/\d\d/)\d\d(?![\w-])|\d\d(?:\.\d\d\.|/\d\d/)\d{4}(?!\w)"
         r"|(?<!-)\d{3}-\d\d-\d{4}(?![\w-])|(?:\d{1,3}[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?!\w)")
#: The kinds and their patterns, in the order in which they are tried.
KINDS = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){1,8}+"),
    ("ip", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"),
    ("ymd", r"(?<![\w-])\d{4}([-/])\d{2}\1\d{2}(?![\w-])"),
    ("dmy", r"(?<!\w)\d{2}([./])\d{2}\2\d{4}(?!\w)"),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    ("phone", r"(?<![\w(])(?:\+?\d{1,3}[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)"),
    ("card", r"(?<![\w.])(?=\d(?:[ -]?\d){12})\d++(?!\w)(?:[ -](?!" + OTHER + r")\d++(?!\w))*+"),
)
ANY = "|".join(pattern for _, pattern in KINDS)
ROUNDS = 10
#: How many numbers the two halves of an SSN, a date and an address take (898 areas, 99 groups, 9999 serials).
SSN, DAYS, ADDRESS = (898 * 99, 9999), (256, 256), (65536, 65536)
#: The same for dates with a day over 12.
LATE_DAYS = (85, 467)
#: How cards are written, the first that fits first: 13 to 19 digits in one group, else these groups.
LAYOUTS = (None, (4, 4, 4, 4), (4, 6, 5), (4, 4, 4, 4, 3))
#: How often the cards of a run are permuted before it counts as an error; each time fails with about one in ten.
WALK = 60
LETTERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"


def _div(x: Column, n: Column) -> Column:
    """Whole quotient of two longs."""
    return F.call_function("div", x, n)


def _round(key: str, tag: Column, turn: Column, half: Column) -> Column:
    text = F.concat_ws("|", F.lit(key), tag, turn.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long")


def feistel(x: Column, a: Column, b: Column, tag: Column, key: str, invert: bool = False) -> Column:
    """Keyed permutation of 0 .. a*b - 1; the halves are x div b and x mod b, moved in turns."""
    sign = -1 if invert else 1
    turns = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if invert else F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def step(s: Column, i: Column) -> Column:
        left = F.pmod(s["l"] + sign * F.pmod(_round(key, tag, i, s["r"]), a), a)
        right = F.pmod(s["r"] + sign * F.pmod(_round(key, tag, i, s["l"]), b), b)
        return F.struct(F.when(i % 2 == 0, left).otherwise(s["l"]).alias("l"),
                        F.when(i % 2 == 0, s["r"]).otherwise(right).alias("r"))

    start = F.struct(_div(x, b).alias("l"), F.pmod(x, b).alias("r"))
    return F.aggregate(turns, start, step, lambda s: s["l"] * b + s["r"])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"\D", "")


def _refill(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced in order."""
    chars = F.split(m, "")
    return F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), lambda s, c: F.struct(
        F.concat(s["out"], F.when(c.rlike(r"^\d$"), F.call_function("substring", digits, s["at"], F.lit(1))).otherwise(c)).alias("out"),
        (s["at"] + c.rlike(r"^\d$").cast("int")).alias("at")), lambda s: s["out"])


def _luhn(digits: Column) -> Column:
    """The check digit that goes after ``digits``."""
    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    doubled = F.transform(chars, lambda c, i: F.when(i % 2 == 0, F.when(
        c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return F.pmod(10 - F.pmod(F.aggregate(doubled, F.lit(0), lambda a, d: a + d), F.lit(10)), F.lit(10)).cast("string")


def _ten(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("long")


def _day(y: Column, m: Column, d: Column) -> Column:
    """Days since 1900-01-01, NULL if there is no such date or it is outside the range."""
    date = F.concat_ws("-", y, m, d).try_cast("date")
    day = F.datediff(date, F.lit("1900-01-01").cast("date")).cast("long")
    return F.when(F.date_format(date, "yyyy-MM-dd") == F.concat_ws("-", y, m, d), day)


def _bind(x: Column, f) -> Column:
    """``f`` of ``x``, which is evaluated once."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _cards(m: Column) -> Column:
    """The cards in a run of digit groups: array<struct<at, n>>, in digits from 0, ordered."""
    window = "struct<rank:int,i:int,k:int>"

    def scan(groups: Column, marks: Column) -> Column:
        sizes, n = F.transform(groups, F.length), F.size(groups)
        digits = lambda i, k: F.array_join(F.slice(groups, i + 1, k), "")
        right = lambda d: F.length(d).between(13, 19) & (_luhn(F.left(d, F.length(d) - 1)) == F.right(d, F.lit(1)))

        def written(rank: int, shape: tuple[int, ...] | None) -> Column:
            k = len(shape or (0,))
            def fits(i: Column) -> Column:
                if shape is None:
                    return F.get(sizes, i).between(13, 19)
                return (F.slice(sizes, i + 1, k) == F.array(*map(F.lit, shape))) & (
                    F.size(F.array_distinct(F.slice(marks, i + 1, k - 1))) <= 1)
            at = F.filter(F.sequence(F.lit(0), n - 1), fits)
            return F.transform(at, lambda i: F.struct(F.lit(rank).alias("rank"), i.alias("i"), F.lit(k).alias("k")))

        def first(out: Column, w: Column) -> Column:
            meets = F.exists(out, lambda o: (o["i"] < w["i"] + w["k"]) & (w["i"] < o["i"] + o["k"]))
            return F.when(~meets & right(digits(w["i"], w["k"])), F.concat(out, F.array(w))).otherwise(out)

        def rest(taken: Column) -> Column:
            def at(s: Column, i: Column) -> Column:
                end = F.coalesce(F.array_min(F.filter(F.transform(taken, lambda o: o["i"]), lambda x: x >= i)), n)
                sized = F.filter(F.sequence(F.lit(0), F.least(F.lit(19), end - i)), lambda k: (k > 0) & right(digits(i, k)))
                inside = F.exists(taken, lambda o: (o["i"] <= i) & (i < o["i"] + o["k"]))
                return _bind(F.when((i >= s["free"]) & ~inside, F.get(sized, F.lit(0))), lambda k: F.when(k.isNull(), s).otherwise(F.struct(
                    (i + k).alias("free"), F.concat(s["out"], F.array(F.struct(F.lit(9).alias("rank"), i.alias("i"), k.alias("k")))).alias("out"))))
            start = F.struct(F.lit(0).alias("free"), taken.alias("out"))
            return F.aggregate(F.sequence(F.lit(0), n - 1), start, at, lambda s: s["out"])

        windows = F.concat(*[written(rank, shape) for rank, shape in enumerate(LAYOUTS)])
        chosen = _bind(F.aggregate(windows, F.array().cast(f"array<{window}>"), first), rest)
        place = lambda i: F.aggregate(F.slice(sizes, F.lit(1), i), F.lit(0), lambda a, x: a + x)
        return F.array_sort(F.transform(chosen, lambda w: F.struct(place(w["i"]).alias("at"), F.length(digits(w["i"], w["k"])).alias("n"))))
    return _bind(F.struct(F.split(m, "[ -]").alias("groups"), F.filter(F.split(m, r"\d+"), lambda c: c != "").alias("marks")),
                 lambda x: scan(x["groups"], x["marks"]))


def _valid(kind: str, m: Column) -> Column:
    part = lambda a, n: F.substring(m, a, n)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda x: (x.cast("int") < 256) & (x == x.cast("int").cast("string")))
    if kind in ("ymd", "dmy"):
        y, mo, d = (part(1, 4), part(6, 2), part(9, 2)) if kind == "ymd" else (part(7, 4), part(4, 2), part(1, 2))
        day = _day(y, mo, d)
        right = F.coalesce((day >= 0) & (day < DAYS[0] * DAYS[1]), F.lit(False))
        if kind == "dmy":
            late = _day(y, d, mo)
            right = right | (m.contains("/") & F.coalesce((late >= 0) & (late < DAYS[0] * DAYS[1]) & (mo > "12"), F.lit(False)))
        return right
    if kind == "ssn":
        area = part(1, 3).cast("int")
        return (area > 0) & (area != 666) & (area < 900) & (part(5, 2) != "00") & (part(8, 4) != "0000")
    if kind == "card":
        return F.size(_cards(m)) > 0
    return F.lit(True)


def _swap(kind: str, m: Column, key: str, invert: bool) -> Column:
    part = lambda a, n: F.substring(m, a, n)
    run = lambda x, ab, tag=kind: feistel(x, F.lit(ab[0]).cast("long"), F.lit(ab[1]).cast("long"), F.lit(tag), key, invert)
    bind = _bind
    if kind == "email":
        local = F.regexp_extract(m, "^[^@]*", 0)
        return F.concat(_letters(local, key, invert), F.regexp_extract(m, "@.*$", 0))
    if kind == "ip":
        x = F.aggregate(F.split(m, r"\."), F.lit(0).cast("long"), lambda a, o: a * 256 + o.cast("long"))
        return bind(run(x, ADDRESS), lambda y: F.concat_ws(".", *[
            F.pmod(F.shiftright(y, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)]))
    if kind in ("ymd", "dmy"):
        y, mo, d = (part(1, 4), part(6, 2), part(9, 2)) if kind == "ymd" else (part(7, 4), part(4, 2), part(1, 2))
        new = F.date_add(F.lit("1900-01-01").cast("date"), run(_day(y, mo, d), DAYS, "date").cast("int"))
        out = _refill(m, F.date_format(new, "yyyyMMdd" if kind == "ymd" else "ddMMyyyy"))
        return out if kind == "ymd" else F.when(mo > "12", _refill(m, _late(y, d, mo, run))).otherwise(out)
    if kind == "ssn":
        area = part(1, 3).cast("long")
        index = ((area - F.when(area > 666, 2).otherwise(1)) * 99 + part(5, 2).cast("long") - 1) * SSN[1] + part(8, 4).cast("long") - 1

        def write(y: Column) -> Column:
            serial = F.pmod(y, F.lit(SSN[1])) + 1
            rest = _div(y, F.lit(SSN[1]))
            group = F.pmod(rest, F.lit(99)) + 1
            first = _div(rest, F.lit(99)) + 1
            first = first + F.when(first > 665, 1).otherwise(0)
            return F.concat_ws("-", F.lpad(first.cast("string"), 3, "0"), F.lpad(group.cast("string"), 2, "0"),
                               F.lpad(serial.cast("string"), 4, "0"))
        return bind(run(index, SSN), write)
    if kind == "phone":
        return bind(_digits(m), lambda d: _refill(m, F.concat(
            F.left(d, F.length(d) - 10), F.lpad(run(F.right(d, F.lit(10)).cast("long"), (10**5, 10**5)).cast("string"), 10, "0"))))

    def card(d: Column) -> Column:
        n = F.length(d) - 1
        low = _div(n, F.lit(2)).cast("int")
        new = feistel(F.left(d, n).cast("long"), _ten(n - low), _ten(low), F.concat(F.lit("card"), n.cast("string")), key, invert)
        return bind(F.call_function("lpad", new.cast("string"), n, F.lit("0")), lambda s: F.concat(s, _luhn(s)))

    def once(word: Column, cards: Column) -> Column:
        cut = lambda d, at, n: F.call_function("substring", d, at + 1, n)
        return bind(_digits(word), lambda d: _refill(word, F.aggregate(
            cards, F.struct(F.lit(0).alias("now"), F.lit("").alias("out")), lambda s, c: F.struct(
                (c["at"] + c["n"]).alias("now"),
                F.concat(s["out"], cut(d, s["now"], c["at"] - s["now"]), bind(cut(d, c["at"], c["n"]), card)).alias("out")),
            lambda s: F.concat(s["out"], cut(d, s["now"], F.length(d))))))

    return bind(_cards(m), lambda cards: F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), F.struct(m.alias("out"), F.lit(False).alias("done")), lambda s, _: F.when(s["done"], s).otherwise(
            bind(once(s["out"], cards), lambda w: F.struct(w.alias("out"), (_cards(w) == cards).alias("done")))),
        lambda s: F.when(s["done"], s["out"]).otherwise(F.raise_error(F.lit("a run of digit groups found no stable pseudonym")).cast("string"))))


def _late(y: Column, mo: Column, d: Column, run) -> Column:
    """The new MMddyyyy of a date whose day is over 12; such dates are numbered without the first 12 days of each month."""
    first, month = F.lit("1900-01-01").cast("date"), (y.cast("int") - 1900) * 12 + mo.cast("int") - 1
    start = lambda k: F.datediff(F.add_months(first, k), first) - 12 * k

    def write(x: Column) -> Column:
        near = F.floor(x / 18.437).cast("int")
        k = F.array_max(F.filter(F.sequence(near - 2, near + 2), lambda k: start(k) <= x))
        return _bind(k, lambda k: F.date_format(F.date_add(F.add_months(first, k), (x - start(k)).cast("int") + 12), "MMddyyyy"))
    return _bind(run(_day(y, mo, d) - 12 * (month + 1), LATE_DAYS, "late date"), write)


def _letters(s: Column, key: str, invert: bool) -> Column:
    """Feistel on the characters: each half is shifted letter by letter by a hash of the other half, the classes
    and places of its characters; letters move among letters and digits among digits, others stay."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(s, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    cut = _div(F.length(s), F.lit(2)).cast("int")
    turns = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if invert else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    sign = -1 if invert else 1

    def shift(half: Column, other: Column, i: Column) -> Column:
        stream = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), shape, i.cast("string"), other), 256)

        def move(c: Column, j: Column) -> Column:
            by = F.conv(F.call_function("substring", stream, F.pmod(j, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int")
            out = c
            for alphabet in (LETTERS, LETTERS.upper(), DIGITS):
                n = len(alphabet)
                at = F.call_function("instr", F.lit(alphabet), c)
                out = F.when(at > 0, F.call_function("substring", F.lit(alphabet), F.pmod(at - 1 + sign * by, F.lit(n)) + 1, F.lit(1))).otherwise(out)
            return out
        return F.array_join(F.transform(F.filter(F.split(half, ""), lambda c: c != ""), move), "")

    start = F.struct(F.left(s, cut).alias("l"), F.call_function("substring", s, cut + 1, F.length(s)).alias("r"))
    return F.aggregate(turns, start, lambda t, i: F.struct(
        F.when(i % 2 == 0, shift(t["l"], t["r"], i)).otherwise(t["l"]).alias("l"),
        F.when(i % 2 == 1, shift(t["r"], t["l"], i)).otherwise(t["r"]).alias("r")), lambda t: F.concat(t["l"], t["r"]))


def _classified(m: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(KINDS):
        core = pattern.replace(r"\2", r"\1") if name == "dmy" else r"\d+(?:[ -]\d+)*" if name == "card" else pattern
        kind = F.when(m.rlike(f"^(?:{core})$") & _valid(name, m), name).otherwise(kind)
    return kind


def pseudonymise(docs: DataFrame, key: str, invert: bool = False, text_col: str = "text", counts_col: str = "pii") -> DataFrame:
    """``docs`` with pseudonyms in ``text_col`` and the number of values changed per kind in ``counts_col``."""
    text = F.col(text_col)
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    told = F.transform(F.transform(found, lambda m: F.struct(m.alias("word"), _classified(m).alias("kind"))), lambda x: F.struct(
        x["word"].alias("word"), x["kind"].alias("kind"), F.when(x["kind"] == "card", F.size(_cards(x["word"]))).otherwise(1).alias("n")))

    def change(x: Column) -> Column:
        out = x["word"]
        for name, _ in reversed(KINDS):
            out = F.when(x["kind"] == name, _swap(name, x["word"], key, invert)).otherwise(out)
        return out

    gaps = F.split(text, ANY, -1)
    rows = docs.withColumns({"_pii_told": told, "_pii_gaps": gaps})
    none = F.size("_pii_told") <= 0
    woven = F.array_join(F.zip_with("_pii_gaps", F.transform("_pii_told", change),
                                    lambda g, w: F.concat(g, F.coalesce(w, F.lit("")))), "")
    count = lambda name: F.when(none | text.isNull(), 0).otherwise(
        F.aggregate(F.filter("_pii_told", lambda x: x["kind"] == name), F.lit(0), lambda a, x: a + x["n"])).cast("long").alias(name)
    return (rows.withColumn(counts_col, F.struct(*[count(name) for name, _ in KINDS]))
            .withColumn(text_col, F.when(none, text).otherwise(woven)).drop("_pii_told", "_pii_gaps"))
