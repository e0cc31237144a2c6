"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Found and validated: payment card numbers (Luhn), North American and other international phone
numbers, US social security numbers, IPv4 addresses, calendar dates (ISO, and day.month.year or
day/month/year), e-mail addresses, and access keys or passwords (``AKIA...``, ``password=...``).
Each value becomes another of its own format by a keyed Feistel permutation: its symbols (digits,
letters, octets, or a day number as two mixed-radix digits) are split into two halves, and each
round adds to one half, symbol by symbol and modulo the symbol's radix, a keyed hash of the other.
That is a bijection on the format, so equal values stay linked across documents and different
ones stay different; it needs no table and no shuffle.  Cards keep their first digit and get a
new check digit; dates permute within a 400-year Gregorian cycle.

Cases: a NULL text stays NULL; a text without candidates is returned as it is; candidates that
fail validation are left; values of fewer than two symbols to permute are left; rows are treated
one by one, so repeats, NULL ids and other columns (all kept) change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import fresh

ROUNDS = 8
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: 400 Gregorian years are 146097 = 189 * 773 days; the cycle that holds today's dates.
CYCLE_START, CYCLE, SMALL = "1800-01-01", 146097, 189

#: The name before a secret's value, with blanks and quotes around the sign.
NAMED = r"""(?i:password|passwd|secret|api_key|token)["']?[ \t]{0,8}[=:][ \t]{0,8}["']?"""
#: Candidate formats, fixed values; a candidate has no word character right before or after it.
PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    ("secret", r"AKIA[0-9A-Z]{16}|" + NAMED + r"[A-Za-z0-9]{6,}"),
    # North American and unbroken numbers end with their format, so that a number after them stays apart
    ("phone", r"\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}|\+\d{10,15}|\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4}"),
    ("ssn", r"\d{3}-\d{2}-\d{4}"),
    ("date", r"\d{4}-\d{2}-\d{2}|\d{1,2}([./])\d{1,2}\1\d{4}"),
    ("ipv4", r"\d{1,3}(?:\.\d{1,3}){3}"),
    # a whole run of digit groups; the cards are sought in it
    ("card", r"\d[\d -]{11,}\d(?!/\d{1,2}/\d{4}|[\w.%+-]*@)"),
)


def _candidate(patterns) -> str:
    """A Java alternation; group numbers are not used, so the inner group is named away."""
    return r"(?<![\w.+-])(?:" + "|".join(
        p.replace(r"([./])", r"(?<sep>[./])").replace(r"\1", r"\k<sep>") for _, p in patterns) + r")(?![\w-]|\.\d)"


CANDIDATE, SHORT = _candidate(PATTERNS), _candidate(PATTERNS[:-1])
#: Lengths of a card's digit groups that are tried before any others.
USUAL = r"^(\d+|4-4-4-4|4-6-5|4-6-4)$"
PIECES = "array<struct<v:string,kind:string>>"


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``; a repeated sub-expression would run each time."""
    return F.get(F.transform(F.array(value), body), 0)


def _prf(key: str, text: Column, place: Column) -> Column:
    """A keyed hash as a non-negative number below 2^52."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", text, place.cast("string"), F.lit(key)), 256), 1, 13), 16, 10).cast("long")


def feistel(symbols: Column, radices: Column, kind: Column, key: str, rounds: int = ROUNDS) -> Column:
    """Permute an array of symbols, each below its radix; lengths below 2 are returned as they are."""
    def permute(given: Column) -> Column:
        half = given["half"]

        def turn(state: Column, r: Column) -> Column:
            def move(part: Column, other: Column, shift: Column) -> Column:
                text = F.concat_ws("|", F.lit(key), kind, r.cast("string"), F.array_join(other.cast("array<string>"), ","))
                return _let(text, lambda t: F.transform(part, lambda v, i: F.pmod(v + _prf(key, t, i), F.get(given["radices"], shift + i))))

            even = r % 2 == 0
            return F.struct(F.when(even, move(state["l"], state["r"], F.lit(0))).otherwise(state["l"]).alias("l"),
                            F.when(even, state["r"]).otherwise(move(state["r"], state["l"], half)).alias("r"))

        start = F.struct(F.slice(given["symbols"], F.lit(1), half).alias("l"),
                         F.slice(given["symbols"], half + 1, F.size(given["symbols"])).alias("r"))
        done = F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, turn, lambda s: F.concat(s["l"], s["r"]))
        return F.when(half < 1, given["symbols"]).otherwise(done)

    return _let(F.struct(symbols.alias("symbols"), radices.alias("radices"),
                         F.floor(F.size(symbols) / 2).cast("int").alias("half")), permute)


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _value(c: Column) -> Column:
    """Place of a character in its class, and -1 for one that is kept."""
    return F.when(c.isin(*DIGITS), F.ascii(c) - 48).when(c.isin(*LOWER), F.ascii(c) - 97).when(
        c.isin(*UPPER), F.ascii(c) - 65).otherwise(F.lit(-1)).cast("long")


def _radix(c: Column) -> Column:
    return F.when(c.isin(*DIGITS), F.lit(10)).otherwise(F.lit(26)).cast("long")


def _base(c: Column) -> Column:
    return F.when(c.isin(*DIGITS), F.lit(48)).when(c.isin(*LOWER), F.lit(97)).otherwise(F.lit(65))


def permute_text(text: Column, kind: Column, key: str) -> Column:
    """Permute a text's ASCII digits and letters, each within its class; other characters stay."""
    def moved(chars: Column) -> Column:
        free = F.filter(chars, lambda c: _value(c) >= 0)
        return F.struct(chars.alias("chars"), feistel(F.transform(free, _value), F.transform(free, _radix), kind, key).alias("new"))

    def write(x: Column) -> Column:
        return F.aggregate(
            x["chars"], F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
            lambda s, c: F.when(_value(c) < 0, F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at")))
            .otherwise(F.struct(F.concat(s["out"], F.char(F.get(x["new"], s["at"]) + _base(c))).alias("out"),
                                (s["at"] + 1).alias("at"))), lambda s: s["out"])

    return _let(_let(_characters(text), moved), write)


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of an array of digits, the last one counted once."""
    n = F.size(digits)
    return F.aggregate(F.transform(digits, lambda d, i: F.when((n - i) % 2 == 0, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)),
                       F.lit(0).cast("long"), lambda a, x: a + x)


def _digits(text: Column) -> Column:
    return F.transform(_characters(F.regexp_replace(text, r"\D", "")), lambda c: c.cast("long"))


def _fill(text: Column, digits: Column) -> Column:
    """The text with its digits replaced in turn."""
    return F.aggregate(
        _characters(text), F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda s, c: F.when(c.isin(*DIGITS), F.struct(F.concat(s["out"], F.get(digits, s["at"]).cast("string")).alias("out"), (s["at"] + 1).alias("at")))
        .otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))), lambda s: s["out"])


def _card(value: Column, key: str) -> Column:
    def moved(d: Column) -> Column:
        body = F.slice(d, F.lit(2), F.size(d) - 2)
        return F.concat(F.slice(d, 1, 1), feistel(body, F.transform(body, lambda x: F.lit(10).cast("long")), F.lit("card"), key))

    def checked(new: Column) -> Column:
        zero = F.lit(0).cast("long")
        check = F.pmod(F.lit(10) - luhn_sum(F.concat(new, F.array(zero))) % 10, F.lit(10)).cast("long")
        return F.concat(new, F.array(check))

    return _let(_let(_let(_digits(value), moved), checked), lambda d: _fill(value, d))


def _phone(value: Column, key: str) -> Column:
    """Country code kept; a digit from 2 to 9 that opens a group moves among those eight."""
    plus = F.regexp_extract(value, r"^\+\d{1,3}(?=[ .(-])|^\+1", 0)

    def marked(chars: Column) -> Column:
        opens = F.transform(chars, lambda c, i: F.struct(
            c.alias("c"), (c.isin(*DIGITS[2:]) & ~F.coalesce(F.when(i > 0, F.get(chars, i - 1)), F.lit("")).isin(*DIGITS)).alias("o")))
        return F.transform(F.filter(opens, lambda x: x["c"].isin(*DIGITS)), lambda x: F.struct(
            x["c"].cast("long").alias("v"), F.when(x["o"], F.lit(2)).otherwise(F.lit(0)).cast("long").alias("low")))

    def moved(m: Column) -> Column:
        new = feistel(F.transform(m, lambda x: x["v"] - x["low"]), F.transform(m, lambda x: F.lit(10) - x["low"]),
                      F.concat(F.lit("phone"), plus), key)
        return F.zip_with(new, m, lambda a, b: a + b["low"])

    local = F.substr(value, F.length(plus) + 1)
    digits = _let(_let(_characters(local), marked), moved)
    return F.concat(plus, _let(digits, lambda d: _fill(local, d)))


def _ipv4(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    radices = F.array(*[F.lit(256).cast("long")] * 4)
    return F.array_join(feistel(octets, radices, F.lit("ipv4"), key).cast("array<string>"), ".")


def _day(value: Column) -> Column:
    """The day of a date in one of the formats; NULL if there is no such day or it is out of the cycle."""
    iso = value.rlike(r"^\d{4}-")
    part = F.split(value, r"[./-]")
    y, d = F.when(iso, F.get(part, 0)).otherwise(F.get(part, 2)), F.when(iso, F.get(part, 2)).otherwise(F.get(part, 0))
    day = F.try_to_date(F.concat_ws("-", y, F.lpad(F.get(part, 1), 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    return F.when(day.between(F.lit(CYCLE_START).cast("date"), F.date_add(F.lit(CYCLE_START).cast("date"), CYCLE - 1)), day)


def _date(value: Column, key: str) -> Column:
    first = F.lit(CYCLE_START).cast("date")
    mark = F.substring(F.regexp_extract(value, r"[./]", 0), 1, 1)
    radices = F.array(F.lit(SMALL), F.lit(CYCLE // SMALL)).cast("array<bigint>")
    pair = _let(F.datediff(_day(value), first).cast("long"), lambda n: feistel(
        F.array(n % SMALL, F.floor(n / SMALL).cast("long")), radices, F.lit("date"), key))
    day = _let(pair, lambda p: F.date_add(first, (F.get(p, 0) + F.get(p, 1) * SMALL).cast("int")))
    return _let(day, lambda d: F.when(value.rlike(r"^\d{4}-"), F.date_format(d, "yyyy-MM-dd")).otherwise(
        F.concat(F.date_format(d, "dd"), mark, F.date_format(d, "MM"), mark, F.date_format(d, "yyyy"))))


def kind_of(value: Column) -> Column:
    """The kind of a candidate that passes validation, else NULL."""
    d = _digits(value)
    octets = F.transform(F.split(value, r"\."), lambda x: x.try_cast("int"))
    test = {
        "email": F.lit(True), "secret": F.lit(True),
        "phone": F.size(d).between(10, 15),
        "ssn": ~value.rlike(r"^(000|666|9\d\d)|-00-|-0000$"),
        "date": _day(value).isNotNull(),
        "ipv4": F.forall(octets, lambda x: F.coalesce(x <= 255, F.lit(False))),
        "card": F.size(d).between(13, 19) & (luhn_sum(d) % 10 == 0) & (F.get(d, 0) > 0),
    }
    out = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS):
        out = F.when(value.rlike(f"^(?:{pattern})$"), F.when(test[name], F.lit(name)).otherwise(out)).otherwise(out)
    return out


def _piece(value: Column, kind: Column) -> Column:
    return F.struct(value.alias("v"), kind.cast("string").alias("kind"))


def _short(text: Column) -> Column:
    """A text's pieces by the patterns other than a card's."""
    zipped = F.arrays_zip(F.split(text, SHORT, -1).alias("gap"), F.regexp_extract_all(text, F.lit(SHORT), 0).alias("hit"))
    return F.flatten(F.transform(zipped, lambda z: F.when(z["hit"].isNull(), F.array(_piece(z["gap"], F.lit(None)))).otherwise(
        F.array(_piece(z["gap"], F.lit(None)), _piece(z["hit"], kind_of(z["hit"]))))))


def _cards(value: Column) -> Column:
    """The pieces of a run of digit groups: every span of whole groups, one sign between each, of 13 to 19
    digits with a valid Luhn sum is a card; usual groupings first, then the earliest, then the longest.
    What is between cards is searched for the other formats."""
    def spans(x: Column) -> Column:
        def of(i: Column, k: Column) -> Column:
            text = F.array_join(F.slice(x["groups"], i + 1, k), "")
            lengths = F.array_join(F.transform(F.slice(x["groups"], i + 1, k), lambda g: F.length(g).cast("string")), "-")
            near = F.forall(F.slice(x["signs"], i + 2, k - 1), lambda g: F.length(g) == 1)
            good = _let(text, lambda t: F.when(F.length(t).between(13, 19) & ~t.startswith("0") & near, luhn_sum(_digits(t)) % 10 == 0))
            return F.when(good, F.struct(F.when(lengths.rlike(USUAL), 0).otherwise(1).alias("tier"), i.alias("i"), (-k).alias("back")))

        n = F.size(x["groups"])
        return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(19), n - i)), lambda k: of(i, k)))))

    def apart(found: Column) -> Column:
        none = F.array().cast("array<struct<i:int,k:int>>")
        return F.array_sort(F.aggregate(F.sort_array(found), none, lambda kept, s: F.when(
            F.exists(kept, lambda o: (o["i"] < s["i"] - s["back"]) & (s["i"] < o["i"] + o["k"])), kept).otherwise(
            F.concat(kept, F.array(F.struct(s["i"].alias("i"), (-s["back"]).alias("k")))))))

    def pieces(x: Column) -> Column:
        # signs and groups in turn: group i is at place 2 i + 1
        parts = F.flatten(F.transform(x["signs"], lambda g, i: F.array(g, F.coalesce(F.get(x["groups"], i), F.lit("")))))

        def between(p: Column, start: Column, stop: Column) -> Column:
            return F.array_join(F.slice(p, start + 1, stop - start), "")

        def write(p: Column) -> Column:
            return F.aggregate(
                apart(spans(x)), F.struct(F.lit(0).alias("at"), F.array().cast(PIECES).alias("out")),
                lambda s, c: F.struct(
                    ((c["i"] + c["k"]) * 2).alias("at"),
                    F.concat(s["out"], _short(between(p, s["at"], c["i"] * 2 + 1)),
                             F.array(_piece(between(p, c["i"] * 2 + 1, (c["i"] + c["k"]) * 2), F.lit("card")))).alias("out")),
                lambda s: F.concat(s["out"], _short(between(p, s["at"], F.size(p)))))

        return _let(parts, write)

    return _let(F.struct(F.regexp_extract_all(value, F.lit(r"\d+"), 0).alias("groups"),
                         F.split(value, r"\d+", -1).alias("signs")), pieces)


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    local, domain = F.regexp_extract(value, r"^([^@]*)(@.*)$", 1), F.regexp_extract(value, r"^([^@]*)(@.*)$", 2)
    head = F.regexp_extract(value, "^(AKIA|" + NAMED + ")", 1)
    tail = F.substr(value, F.length(head) + 1)
    return (F.when(kind == "email", F.concat(permute_text(local, F.concat(F.lit("email"), domain), key), domain))
            .when(kind == "secret", F.concat(head, permute_text(tail, F.lit("secret"), key)))
            .when(kind == "phone", _phone(value, key)).when(kind == "ssn", permute_text(value, kind, key))
            .when(kind == "date", _date(value, key)).when(kind == "ipv4", _ipv4(value, key))
            .when(kind == "card", _card(value, key)).otherwise(value))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the personal data of ``text_col`` replaced, and ``pii`` appended: an array of
    (kind, start, original_length, pseudonym), ``start`` counted in characters from 0 of the original text."""
    text = F.col(f"`{text_col}`")
    # every candidate holds one of these; most texts are passed over by this one cheap scan
    has = text.rlike("[0-9@=]|AKIA|" + NAMED)
    found = F.when(has, F.regexp_extract_all(text, F.lit(CANDIDATE), 0)).otherwise(F.array().cast("array<string>"))
    between = F.when(has, F.split(text, CANDIDATE, -1)).otherwise(F.array(F.lit("")))
    prefix = fresh(docs, "__pii")
    names = {n: f"{prefix}_{n}" for n in ("found", "between", "kinds", "new", "done")}
    whole = F.transform(names["found"], lambda v: F.when(v.rlike(r"^\d[\d -]{11,}\d$"), _cards(v)).otherwise(F.array(_piece(v, kind_of(v)))))
    with_kind = F.flatten(F.transform(
        F.arrays_zip(F.col(names["between"]).alias("gap"), whole.alias("x")),
        lambda z: F.concat(F.array(_piece(z["gap"], F.lit(None))), F.coalesce(z["x"], F.array().cast(PIECES)))))
    replaced = F.transform(names["kinds"], lambda x: F.struct(
        x["v"].alias("v"), x["kind"].alias("kind"), pseudonym(x["v"], x["kind"], key).alias("new")))
    starts = F.aggregate(
        F.col(names["new"]),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<kind:string,start:int,original_length:int,pseudonym:string>>").alias("out"),
                 F.lit("").alias("text")),
        lambda s, x: F.struct(
            (s["at"] + F.length(x["v"])).alias("at"),
            F.when(x["kind"].isNotNull(), F.concat(s["out"], F.array(F.struct(
                x["kind"].alias("kind"), s["at"].alias("start"),
                F.length(x["v"]).alias("original_length"), x["new"].alias("pseudonym"))))).otherwise(s["out"]).alias("out"),
            F.concat(s["text"], x["new"]).alias("text")))
    none = F.array().cast("array<struct<kind:string,start:int,original_length:int,pseudonym:string>>")
    plain = docs.select("*", found.alias(names["found"]), between.alias(names["between"]))
    steps = plain.withColumn(names["kinds"], with_kind).withColumn(names["new"], replaced)
    done = steps.withColumn(names["done"], F.when(F.size(names["found"]) > 0, starts))
    return done.select(*[F.coalesce(F.col(names["done"] + ".text"), text).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns],
                       F.coalesce(F.col(names["done"] + ".out"), none).alias("pii"))
