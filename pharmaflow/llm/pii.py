"""Op 10, personal data replaced by keyed surrogates.

One pattern finds e-mail addresses, phone, card and social security numbers, IPv4
addresses, secrets after a label (or 32 and more hex digits) and names after a form of
address. Each mention has a canonical form (an address in lower case, a number's
digits, a name's word), so all its spellings share a surrogate (coreference). The
surrogate is drawn from SHA-256 over secret, kind, canonical form and attempt, character by
character: digits stay digits, letters stay letters of their script, punctuation
stays. Cards keep their first digit and whether their Luhn sum holds, IPv4 parts stay within
range, hex stays hex, an address keeps its last domain part, and names are built from
syllables of their script with an ending of the gender that the form of address tells.
The mention's own layout and capitals are put back.

Collision checks: a surrogate that two canonical forms of a kind would share, or that equals
any canonical form found in the corpus, is drawn again with the next attempt, until all are
distinct.

Scale: texts without a mention pass through unchanged and unshuffled. The table of
canonical forms is counted map-side; mentions meet it in a key join that AQE may split for a
hot mention, and go back to their text by row key. Column expressions only.

Defined cases: NULL and empty texts stay; NULL ids are no obstacle (rows have keys of their own);
repeated rows get the same replacements; an empty table gives an empty result; the
input's further columns travel inside ``row``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import evaluated, register, saved, table

SECRET = "pii-demo-key"  # give your own to ``surrogates``
ATTEMPTS = 64

# Forms of address and the gender they tell.
MALE = r"Mr\.|Herrn?|Sr\.|Señor|Monsieur|Господин|Κύριος"
FEMALE = r"Mrs\.|Ms\.|Miss|Frau|Sra\.|Srta\.|Señora|Señorita|Madame|Mme\.|Mademoiselle|Госпожа|Κυρία"
NEUTRAL = r"Mx\.|Dr\.|Prof\."
_WORD = r"\p{Lu}[\p{L}'’-]+"
NAME = rf"(?<![\p{{L}}\p{{N}}])(?:{MALE}|{FEMALE}|{NEUTRAL}) {_WORD}(?: {_WORD})?"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63}){1,8}"
_BYTE = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
IP = rf"(?<![\d.]){_BYTE}(?:\.{_BYTE}){{3}}(?!\.?\d)"
CARD = r"(?<![\d.])(?:(?:\d{4}[ -]){3}\d{1,7}|\d{13,19})(?!\d)"
# after a +, 7 to 23 digits in groups of any size, or a shorter number in groups of two and more
PHONE = (r"(?<![\d.])(?:\+\d(?:\)?[ .-]?\(?\d){6,22}"
         r"|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}"
         r"|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\d)")
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_LABEL = r"(?i:token|api[_-]?key|access[_-]?key|secret|password|passwd)[ \t]{0,3}[=:][ \t]{0,3}[\"']?"
SECRETS = rf"(?<![\p{{L}}\p{{N}}]){_LABEL}[A-Za-z0-9_/+-]{{8,}}+|(?<![\p{{L}}\p{{N}}])[0-9A-Fa-f]{{32,}}+(?![\p{{L}}\p{{N}}])"
ANY = "|".join([EMAIL, SECRETS, IP, CARD, PHONE, SSN, NAME])
#: Every alternative of ``ANY`` contains one of these signs, so texts without any hold no
#: mention; cheaper than ``ANY``.
SIGNS = rf"@|\d{{3}}|\.\d|\+\d|(?:{MALE}|{FEMALE}|{NEUTRAL}) |{_LABEL}|[0-9A-Fa-f]{{32}}"

_CYRILLIC, _GREEK = "бвгдзклмнпрст", "βγδζκλμνπρστ"


def _label() -> Column:
    """What stays before the replaced part of a mention: a label or a form of address."""
    return F.regexp_extract("m", rf"^(?:{_LABEL}|(?:{MALE}|{FEMALE}|{NEUTRAL}) )", 0)


def _kind() -> Column:
    m = F.col("m")
    return (F.when(m.rlike(rf"^(?:{EMAIL})$"), "email").when(m.rlike(rf"^(?:{SECRETS})$"), "secret")
            .when(m.rlike(rf"^(?:{IP})$"), "ip").when(m.rlike(rf"^(?:{CARD})$"), "card").when(m.rlike(rf"^(?:{SSN})$"), "ssn")
            .when(m.rlike(rf"^(?:{NAME})$"), F.when(m.rlike(rf"^(?:{MALE})"), "name_m").when(m.rlike(rf"^(?:{FEMALE})"), "name_f")
                  .otherwise("name_x")).otherwise("phone"))


def _canonical(kind: Column, part: Column) -> Column:
    return (F.when(kind.isin("card", "phone", "ssn"), F.regexp_replace(part, r"\D", ""))
            .when(kind.isin("secret", "ip"), part).otherwise(F.lower(part)))


def _mentions(rows: DataFrame) -> DataFrame:
    """(key, pos, word, kind, form, part, label) of ``rows(key, found)``. A name with two words gives
    two parts: a given name of the person's gender and a surname."""
    d = rows.select("key", F.posexplode("found").alias("pos", "m")).select("key", "pos", _kind().alias("kind"), _label().alias("label"), "m")
    d = d.withColumn("rest", F.expr("substring(m, length(label) + 1)"))
    named = F.col("kind").startswith("name")
    d = d.select("key", "pos", "kind", "label", F.posexplode(
        F.when(named, F.split("rest", " ")).otherwise(F.array("rest"))).alias("word", "part"), F.size(F.split("rest", " ")).alias("n"))
    kind = F.when(named & (F.col("word") == F.col("n") - 1), "surname").otherwise(F.col("kind"))
    label = F.when(F.col("word") == 0, F.col("label")).otherwise("")
    return d.select("key", "pos", "word", label.alias("label"), "part", kind.alias("kind"), _canonical(F.col("kind"), F.col("part")).alias("form"))


def _draw(secret: str) -> tuple[Column, ...]:
    """The byte stream of (kind, form) at ``attempt``, and the surrogates it gives."""
    def block(n):
        return F.sha2(F.concat_ws("|", F.lit(secret), "kind", "form", F.col("attempt").cast("string"), n.cast("string")), 256)

    n = F.length("form")
    stream = F.array_join(F.transform(F.sequence(F.lit(0), F.floor(n / 32).cast("int") + 2), block), "")

    def byte(i):  # the i-th byte of the stream
        return F.conv(F.col("stream").substr(i * 2 + 1, F.lit(2)), 16, 10).cast("int")

    def pick(alphabet, i):
        return F.substring(F.lit(alphabet), byte(i) % F.lit(len(alphabet)) + 1, F.lit(1))

    chars = F.split("form", "")
    is_hex = F.col("form").rlike("^[0-9a-fA-F]+$")
    keep_from = F.when(F.col("kind") == "email", n - F.length(F.substring_index("form", ".", -1)) - 1).otherwise(n)

    def one(c, i):
        return (F.when((i >= keep_from) | ((i == 0) & F.col("kind").isin("card", "phone")), c)
                .when(c.rlike("[0-9]"), pick("0123456789", i))
                .when(F.col("is_hex") & c.rlike("[a-f]"), pick("abcdef", i)).when(F.col("is_hex") & c.rlike("[A-F]"), pick("ABCDEF", i))
                .when(c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", i))
                .when(c.rlike(r"\p{IsCyrillic}"), pick(_CYRILLIC, i)).when(c.rlike(r"\p{IsGreek}"), pick(_GREEK, i))
                .when(c.rlike(r"\p{L}"), pick("abcdefghijklmnopqrstuvwxyz", i)).otherwise(c))

    shaped = F.array_join(F.transform(F.col("chars"), one), "")
    ip = F.concat_ws(".", *[((byte(F.lit(i)) % 223) + 1 if i == 0 else byte(F.lit(i))).cast("string") for i in range(4)])

    def syllables(consonants, vowels, endings):
        body = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(1) + F.col("attempt")), lambda i: F.concat(
            pick(consonants, i * 2 + 4), pick(vowels, i * 2 + 5))), "")
        end = F.when(F.col("kind") == "name_f", endings[0]).when(F.col("kind") == "name_m", endings[1]).otherwise(endings[2])
        return F.concat(body, pick(consonants, F.lit(3)), end)

    name = (F.when(F.col("form").rlike(r"\p{IsCyrillic}"), syllables(_CYRILLIC, "аеиоу", ("а", "ий", "ов")))
            .when(F.col("form").rlike(r"\p{IsGreek}"), syllables(_GREEK, "αεηιο", ("α", "ος", "ου")))
            .otherwise(syllables("bdfgklmnprstvz", "aeiou", ("a", "o", "er"))))
    return stream, chars, is_hex, shaped, ip, name


def _luhn(s: Column) -> Column:
    """Luhn sum of a digit string, modulo 10."""
    digits = F.transform(F.reverse(F.split(s, "")), lambda c: c.cast("int"))
    parts = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).otherwise(
        2 * d - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x) % 10


def _drawn(d: DataFrame, secret: str) -> DataFrame:
    stream, chars, is_hex, shaped, ip, name = _draw(secret)
    d = d.withColumns({"stream": stream, "chars": chars, "is_hex": is_hex})
    d = d.withColumn("s", F.when(F.col("kind") == "ip", ip).when(
        F.col("kind").startswith("name") | (F.col("kind") == "surname"), name).otherwise(shaped))
    # a card's last digit is set so that the Luhn sum holds, or fails, as before
    base = F.concat(F.expr("substring(s, 1, length(s) - 1)"), F.lit("0"))
    last = (10 - _luhn(base) + F.when(_luhn(F.col("form")) == 0, 0).otherwise(1 + F.length("form") % 5)) % 10
    card = F.concat(F.expr("substring(s, 1, length(s) - 1)"), last.cast("string"))
    return d.withColumn("s", F.when(F.col("kind") == "card", card).otherwise(F.col("s"))).drop("stream", "chars", "is_hex")


def surrogates(forms: DataFrame, secret: str = SECRET) -> DataFrame:
    """(kind, form, s): a distinct surrogate for each row of ``forms(kind, form)``, none of
    them a form of the same kind itself."""
    kind = F.when(F.col("kind").startswith("name"), "name").otherwise(F.col("kind"))
    real = forms.select(kind.alias("family"), F.col("form").alias("s")).distinct()
    open_, settled = forms.withColumn("attempt", F.lit(0)), None
    for _ in range(ATTEMPTS):
        drawn = saved(_drawn(open_, secret).withColumn("family", kind), "pii-drawn")
        first = drawn.groupBy("family", "s").agg(F.min(F.struct("form", "kind")).alias("winner"))
        taken = real if settled is None else real.unionByName(settled.select("family", "s"))
        won = first.join(taken, ["family", "s"], "left_anti").select(
            "family", "s", F.col("winner.form").alias("form"), F.col("winner.kind").alias("kind"))
        won = won.select("kind", "form", "family", "s")
        settled = saved(won if settled is None else settled.unionByName(won), "pii-settled")
        open_ = saved(drawn.select("kind", "form", "attempt").join(settled, ["kind", "form"], "left_anti").withColumn(
            "attempt", F.col("attempt") + 1), "pii-open")
        if open_.isEmpty():
            return settled.select("kind", "form", "s")
    raise ValueError(f"no distinct surrogates after {ATTEMPTS} attempts")


def _laid_out() -> Column:
    """Surrogate ``s`` in the layout and capitals of the mention ``part``."""
    digits = F.aggregate(F.split("part", ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("i")), lambda a, c: F.when(
        c.rlike("[0-9]"), F.struct(F.concat(a["out"], F.col("s").substr(a["i"], F.lit(1))).alias("out"), (a["i"] + 1).alias("i")))
        .otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["i"].alias("i"))))["out"]
    cased = F.array_join(F.zip_with(F.split("part", ""), F.split("s", ""), lambda p, s: F.when(
        p.rlike(r"\p{Lu}"), F.upper(s)).otherwise(s)), "")
    capital = F.concat(F.upper(F.substring("s", 1, 1)), F.when(
        (F.col("part") == F.upper("part")) & (F.length("part") > 1), F.upper(F.expr("substring(s, 2)"))).otherwise(F.expr("substring(s, 2)")))
    return (F.when(F.col("kind").isin("card", "phone", "ssn"), digits).when(F.col("kind") == "email", cased)
            .when(F.col("kind").startswith("name") | (F.col("kind") == "surname"), capital).otherwise(F.col("s")))


def replace_pii(df: DataFrame, text_col: str = "text", secret: str = SECRET) -> DataFrame:
    """``row`` (the input row as a struct), the ``text`` with surrogates, and ``n_replaced``."""
    rows = df.select(F.struct("*").alias("row"), F.col(text_col).alias("t"))
    rows = evaluated(rows.withColumn("found", F.when(F.col("t").rlike(SIGNS), F.regexp_extract_all("t", F.lit(ANY), F.lit(0)))))
    hit = F.coalesce(F.size("found"), F.lit(0)) > 0
    plain = rows.where(~hit).select("row", F.col("t").alias("text"), F.lit(0).cast("long").alias("n_replaced"))
    hits = saved(rows.where(hit).withColumn("key", F.monotonically_increasing_id()), "pii-hits")
    said = saved(_mentions(hits), "pii-mentions")
    forms = saved(said.select("kind", "form").distinct(), "pii-forms")
    known = surrogates(forms, secret)
    done = said.join(known, ["kind", "form"]).select("key", "pos", "word", F.concat("label", _laid_out()).alias("new"))
    done = done.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("pos", "word", "new"))).alias("news"))
    d = hits.join(done, "key")
    # a later word of the same mention follows a space, the next mention follows the text between
    parts = F.split("t", ANY, -1)
    d = d.select("row", F.size("found").cast("long").alias("n_replaced"), "news", parts.alias("parts"))
    text = F.concat(F.get("parts", F.lit(0)), F.array_join(F.transform("news", lambda x, i: F.concat(
        F.when(x["word"] > 0, F.lit(" ")).otherwise(F.lit("")), x["new"],
        F.when(F.coalesce(F.get("news", i + 1)["pos"] == x["pos"], F.lit(False)), F.lit("")).otherwise(
            F.get("parts", x["pos"] + 1)))), ""))
    return plain.unionByName(d.select("row", text.alias("text"), "n_replaced"))


@register("op10_pii")
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    return replace_pii(table(spark, sf_dir, "documents")).select("row.doc_id", "text", "n_replaced")
