"""PII: format-preserving Feistel pseudonyms.

Card numbers (Luhn), US social security numbers, IPv4 addresses, international
phone numbers and calendar dates are found, validated and replaced by another
valid value of the same format. A value is encoded as a pair (left, right) of
its format's domain a * b and passed through ``STEPS`` keyed rounds, which in
turn add a keyed SHA-256 of one half to the other, modulo a or b: a permutation
of the domain. Equal values so get equal pseudonyms in every document and, with
the key, can be told back; separators, signs and lengths stay.

===== ========================================= ==============================
kind  validated by                              kept as it is
===== ========================================= ==============================
card  13 to 19 digits, Luhn                     first digit; a new check digit
ssn   area, group and serial in use             -
ip    four numbers up to 255                    -
phone plus sign, 8 to 15 digits                 country code, next digit
date  a day of the years 1600 to 2399           order, separators, padding
email the usual shape                           (keyed hash, not invertible)
===== ========================================= ==============================

What is found but not valid stays; a phone does not go on into another value, and
in a run of digits the valid cards are looked for at its groups. The key of the query, ``KEY``, is public: give your
own where pseudonyms have to hide. A country code
other than 1 does not say how many digits follow: a number of two to four digits
after a blank counts as the phone's. Dates: year first with ``-``; month first
with ``/`` where that is a day, else day first; day first with ``.``. Null texts
stay null, with no findings; rows are treated one by one, so repeated rows get
the same text and an empty table gives no rows. Texts are taken whole; nothing
is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.registry import fresh, query, table

KEY = "quarry"
STEPS = 8
KINDS = ("card", "ssn", "ip", "phone", "date", "email")
#: What each kind looks like, in the order in which they are tried.
EMAIL = r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"  # possessive: any number of labels without recursion
ISO = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
DAY = r"(?:[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})"
IP = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.[0-9])"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
#: The groupings of printed cards, the longest first.
CARDS = (r"[0-9]{4}(?:[ -][0-9]{4}){3}[ -][0-9]{3}", r"[0-9]{4}(?:[ -][0-9]{4}){3}", r"[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}", r"[0-9]{13,19}")
#: A blank and a value of its own: phones and runs of digits do not go on into it.
NEXT = rf" (?:{IP}|{ISO}|{DAY}|{SSN}|{CARDS[1]}|{CARDS[2]})(?![A-Za-z0-9])"
_DIGIT = r"[0-9][ .()-]{0,3}"
PHONE = (r"\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![A-Za-z0-9])"  # country code 1 has ten more digits
         rf"|\+[0-9]{{1,3}}[ .-]?\(?[0-9]{{2,4}}\)?(?:(?!{NEXT})[ .-]?\(?[0-9]{{2,4}}\)?){{1,4}}(?<={_DIGIT * 8})(?<!{_DIGIT * 16})")
#: The country codes of one and two digits; the others have three.
COUNTRY = r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
#: Thirteen digits or more, in which the cards are looked for.
RUN = rf"[0-9](?:[0-9]|(?! (?:{IP}|{ISO}|{DAY}|{SSN}|[0-9]{{1,2}}/[0-9])(?![A-Za-z]))[ -][0-9]){{12,75}}"
BEFORE = r"(?<![A-Za-z0-9_%+-])(?<![^A-Za-z]\.)(?<!^\.)"  # a point may end an abbreviation
FOUND = rf"(?:(?<![A-Za-z0-9._%+-]){EMAIL}|{BEFORE}(?:{PHONE}|{ISO}|{DAY}|{IP}|{SSN}|{RUN}))(?![A-Za-z0-9])"
FIRST_DAY, DAYS_A, DAYS_B = "1600-01-01", 378, 773  # 378 * 773 = the 292194 days of 800 years


def _int(c: Column) -> Column:
    return c.cast("bigint")


def _part(x: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(x, pattern, group)


def feistel(kind: str, left: Column, right: Column, a, b, key: str = KEY) -> Column:
    """Struct (l, r): the pair permuted within a * b."""
    a, b = (n if isinstance(n, Column) else F.lit(n).cast("bigint") for n in (a, b))

    def noise(step: Column, half: Column) -> Column:
        text = F.concat_ws(":", F.lit(key), F.lit(kind), a.cast("string"), b.cast("string"), step.cast("string"), half.cast("string"))
        return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("bigint")

    def turn(pair: Column, step: Column) -> Column:
        l, r = pair["l"], pair["r"]
        return F.when(step % 2 == 0, F.struct(((l + noise(step, r) % a) % a).alias("l"), r.alias("r"))).otherwise(
            F.struct(l.alias("l"), ((r + noise(step, l) % b) % b).alias("r")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(STEPS - 1)),
                       F.struct(_int(left).alias("l"), _int(right).alias("r")), turn)


def permute_digits(kind: str, digits: Column, key: str = KEY) -> Column:
    """A digit string permuted among those of its length (two digits or more)."""
    n = F.length(digits)
    cut = F.floor(n / 2).cast("int")
    pair = feistel(kind, F.substring(digits, F.lit(1), cut), F.substring(digits, cut + 1, n - cut),
                   F.pow(F.lit(10), cut).cast("bigint"), F.pow(F.lit(10), n - cut).cast("bigint"), key)
    return F.transform(F.array(pair), lambda p: F.concat(
        F.lpad(p["l"].cast("string"), cut, "0"), F.lpad(p["r"].cast("string"), n - cut, "0")))[0]


def luhn(digits: Column) -> Column:
    """Luhn sum of a digit string."""
    return F.aggregate(
        F.split(F.reverse(digits), ""), F.struct(F.lit(0).alias("s"), F.lit(0).alias("i")),
        lambda a, d: F.struct((a["s"] + F.when(a["i"] % 2 == 0, d.cast("int")).otherwise(
            F.floor(d.cast("int") * 2 / 10).cast("int") + d.cast("int") * 2 % 10)).alias("s"), (a["i"] + 1).alias("i")),
        lambda a: a["s"])


def refill(x: Column, digits: Column) -> Column:
    """``x`` with its digits replaced in order by ``digits``."""
    return F.aggregate(
        F.split(x, ""), F.struct(F.lit("").alias("t"), F.lit(1).alias("i")),
        lambda a, c: F.when((c >= "0") & (c <= "9"), F.struct(
            F.concat(a["t"], F.substring(digits, a["i"], F.lit(1))).alias("t"), (a["i"] + 1).alias("i"))).otherwise(
            F.struct(F.concat(a["t"], c).alias("t"), a["i"].alias("i"))), lambda a: a["t"])


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _full(pattern: str) -> str:
    return rf"^(?:{pattern})$"


def _date_parts(x: Column) -> Column:
    """(y, m, d, order) of a date, or null."""
    ymd = F.struct(_part(x, r"^(\d+)-", 1).cast("int").alias("y"), _part(x, r"-(\d+)-", 1).cast("int").alias("m"),
                   _part(x, r"-(\d+)$", 1).cast("int").alias("d"), F.lit("ymd").alias("o"))
    one, two = _part(x, r"^(\d+)[./]", 1).cast("int"), _part(x, r"[./](\d+)[./]", 1).cast("int")
    year = _part(x, r"(\d{4})$", 1).cast("int")
    mdy = F.struct(year.alias("y"), one.alias("m"), two.alias("d"), F.lit("mdy").alias("o"))
    dmy = F.struct(year.alias("y"), two.alias("m"), one.alias("d"), F.lit("dmy").alias("o"))

    def day(p: Column) -> Column:
        return p["y"].between(1600, 2399) & p["m"].between(1, 12) & F.when(
            p["m"].between(1, 12) & p["y"].between(1600, 2399),
            p["d"].between(1, F.dayofmonth(F.last_day(F.make_date(p["y"], p["m"], F.lit(1)))))).otherwise(False)

    return (F.when(x.rlike(_full(ISO)), F.when(day(ymd), ymd))
            .when(x.rlike(r"^[0-9]+/") & day(mdy), mdy)
            .when(x.rlike(_full(DAY)), F.when(day(dmy), dmy)))


def kind_of(x: Column) -> Column:
    """The kind of a found value, or null when it is not valid."""
    d = _digits(x)
    octets = F.forall(F.split(x, r"\."), lambda o: o.cast("int") <= 255)
    area = _int(F.substring(d, 1, 3))
    ssn = (area > 0) & (area != 666) & (area < 900) & (F.substring(d, 4, 2) != "00") & (F.substring(d, 6, 4) != "0000")
    return (F.when(x.contains("@"), F.lit("email"))
            .when(x.startswith("+"), F.when(F.length(d).between(8, 15), F.lit("phone")))
            .when(x.rlike(_full(f"{ISO}|{DAY}")), F.when(_date_parts(x).isNotNull(), F.lit("date")))
            .when(x.rlike(_full(IP)), F.when(octets, F.lit("ip")))
            .when(x.rlike(_full(SSN)), F.when(ssn, F.lit("ssn")))
            .when(F.length(d).between(13, 19) & (luhn(d) % 10 == 0), F.lit("card")))


def _is_card(x: Column) -> Column:
    d = _digits(x)
    return F.length(d).between(13, 19) & (luhn(d) % 10 == 0)


def cards_in(run: Column) -> Column:
    """The valid cards in a run of digits, whole groups of it: printed groupings first, then the whole, then the longest."""
    def parts(pattern: str) -> Column:
        return F.regexp_extract_all(run, F.lit(rf"(?<![0-9])(?=({pattern})(?![0-9]))"), 1)

    loose = [parts(rf"[0-9](?:[ -]?[0-9]){{{n - 1}}}") for n in range(19, 12, -1)]
    tried = F.filter(F.concat(*map(parts, CARDS), F.array(run), *loose), _is_card)
    taken = F.aggregate(tried, F.struct(run.alias("rest"), F.array().cast("array<string>").alias("found")), lambda a, c: F.when(
        a["rest"].contains(c), F.struct(F.replace(a["rest"], c, F.lit("|")).alias("rest"), F.array_append(a["found"], c).alias("found"))
    ).otherwise(a))["found"]
    return F.when(run.rlike("[ -]"), taken).otherwise(F.filter(F.array(run), _is_card))


def values_in(x: Column) -> Column:
    """Array of (kind, before): the valid values in what FOUND matches."""
    kind = kind_of(x)
    whole = F.when(kind.isNotNull(), F.array(F.struct(kind.alias("kind"), x.alias("before")))).otherwise(
        F.array().cast("array<struct<kind:string,before:string>>"))
    return F.when(x.rlike(_full(RUN)) & ~x.rlike(_full(f"{ISO}|{DAY}|{IP}|{SSN}")), F.transform(
        cards_in(x), lambda c: F.struct(F.lit("card").alias("kind"), c.alias("before")))).otherwise(whole)


def _card(x: Column, key: str) -> Column:
    d = _digits(x)
    body = F.concat(F.substring(d, 1, 1), permute_digits("card", F.substring(d, F.lit(2), F.length(d) - 2), key))
    check = ((10 - luhn(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")
    return refill(x, F.concat(body, check))


def _ssn(x: Column, key: str) -> Column:
    d = _digits(x)
    area, group, serial = (_int(F.substring(d, i, n)) for i, n in ((1, 3), (4, 2), (6, 4)))
    left = (area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1  # 898 areas of 99 groups
    pair = feistel("ssn", left, serial - 1, 898 * 99, 9999, key)

    def show(p: Column) -> Column:
        a = F.floor(p["l"] / 99)
        a = a + F.when(a + 1 >= 666, 2).otherwise(1)
        return F.format_string("%03d-%02d-%04d", a, p["l"] % 99 + 1, p["r"] + 1)

    return F.transform(F.array(pair), show)[0]


def _ip(x: Column, key: str) -> Column:
    o = F.split(x, r"\.")
    pair = feistel("ip", _int(o[0]) * 256 + _int(o[1]), _int(o[2]) * 256 + _int(o[3]), 65536, 65536, key)
    return F.transform(F.array(pair), lambda p: F.concat_ws(
        ".", *[n.cast("string") for h in (p["l"], p["r"]) for n in (F.floor(h / 256), h % 256)]))[0]


def _phone(x: Column, key: str) -> Column:
    # the digits alone say what the country code is, so a number has one pseudonym in all its spellings
    d = _digits(x)
    keep = F.length(_part(d, rf"^({COUNTRY}|[0-9]{{3}})", 1)) + 1
    return refill(x, F.concat(F.substring(d, F.lit(1), keep),
                              permute_digits("phone", F.substring(d, keep + 1, F.length(d) - keep), key)))


def _date(x: Column, key: str) -> Column:
    p = _date_parts(x)
    number = F.datediff(F.make_date(p["y"], p["m"], p["d"]), F.lit(FIRST_DAY).cast("date"))
    pair = feistel("date", F.floor(number / DAYS_B), number % DAYS_B, DAYS_A, DAYS_B, key)

    def show(q: Column) -> Column:
        day = F.date_add(F.lit(FIRST_DAY).cast("date"), (q["l"] * DAYS_B + q["r"]).cast("int"))
        mark = F.when(x.contains("/"), F.lit("/")).otherwise(F.lit("."))
        padded = x.rlike(r"^[0-9]{2}[./][0-9]{2}[./]")
        dd = F.when(padded, F.lpad(F.dayofmonth(day).cast("string"), 2, "0")).otherwise(F.dayofmonth(day).cast("string"))
        mm = F.when(padded, F.lpad(F.month(day).cast("string"), 2, "0")).otherwise(F.month(day).cast("string"))
        year = F.year(day).cast("string")
        return F.when(p["o"] == "ymd", F.date_format(day, "yyyy-MM-dd")).when(
            p["o"] == "mdy", F.concat(mm, mark, dd, mark, year)).otherwise(F.concat(dd, mark, mm, mark, year))

    return F.transform(F.array(pair), show)[0]


def _email(x: Column, key: str) -> Column:
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws(":", F.lit(key), F.lit("email"), F.lower(x)).cast("binary"), 256), 1, 32),
                    F.lit("@example.invalid"))


def pseudonym(x: Column, kind: Column, key: str = KEY) -> Column:
    out = x
    for name, make in (("card", _card), ("ssn", _ssn), ("ip", _ip), ("phone", _phone), ("date", _date), ("email", _email)):
        out = F.when(kind == name, make(x, key)).otherwise(out)
    return out


def pseudonymize(docs: DataFrame, text_col: str = "text", out_col: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with its text pseudonymized in ``out_col`` and the findings in ``pii``: (kind, before, after)."""
    text = F.col(text_col)
    hits = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(FOUND), 0)).otherwise(F.array().cast("array<string>"))
    held, new = fresh(docs, "_hits"), fresh(docs, "_new")
    rows = docs.withColumn(held, hits).withColumn(
        held, F.transform(held, lambda x: F.struct(x.alias("before"), values_in(x).alias("values"))))
    rows = rows.withColumn(held, F.transform(held, lambda h: F.struct(h["before"], F.transform(h["values"], lambda v: F.struct(
        v["kind"], v["before"], pseudonym(v["before"], v["kind"], key).alias("after"))).alias("values"))))
    pieces = F.zip_with(F.split(text, FOUND), held, lambda a, h: F.concat(a, F.coalesce(F.aggregate(
        h["values"], h["before"], lambda t, v: F.replace(t, v["before"], v["after"])), F.lit(""))))
    rows = rows.withColumn(new, F.when(F.size(held) > 0, F.array_join(pieces, "")).otherwise(text))
    return rows.withColumns({out_col: F.col(new), "pii": F.flatten(F.transform(held, lambda h: h["values"]))}).drop(
        held, new)


@query("op7_pii_pseudonyms")
def op7_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda h: h["kind"] == kind)).alias(f"n_{kind}")

    return rows.select("doc_id", F.size("pii").alias("n_found"), *map(count, KINDS), "text")
