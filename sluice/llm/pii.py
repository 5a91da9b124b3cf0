"""Personal data replaced by keyed, type-consistent surrogates.

Found are e-mail addresses, telephone numbers, IPv4 addresses, payment card
numbers (only with a right check digit), social security numbers, credentials
after words such as ``token =``, names after forms of address and titles, and
every later or earlier bare mention of such a name, or of a part of it, in the
same text.

Every entity has a canonical form (lower case, digits only, a telephone number
without its country code), so that its mentions in any format share one
surrogate. Names are two kinds of entities, given and family names, so that
``Anna Weber``, ``Mrs Weber`` and ``Anna`` stay one person. A surrogate keeps
what its type shows: letters stay letters of the same script and case, digits
stay digits, punctuation stays; a given name stays masculine or feminine by its
forms of address, a card number keeps its first digit and a right check digit, a
private address stays private, a mail address keeps its top-level domain.

Surrogates are drawn from SHA-256 of a key, the type, the canonical form and the
attempt. A draw that equals another entity's, or any value of the corpus, is
drawn again until none does. In a format of which the corpus holds a good part
of all values that cannot end; there the surrogate is the next valid value on a
keyed cycle through the whole format (the inverse of a keyed permutation, a
step, the permutation), which is a permutation itself: distinct values stay
distinct and none stays itself, though one may be another's old value.

Only texts with an entity are taken apart: mentions are joined with the table of
distinct entities and put back by position. A text without one passes through
unchanged.

Defined cases: a null or empty text stays as it is; a value in which nothing can
change (no letter or digit) is no entity; letters of scripts without an alphabet
here become Latin ones; rows with a null id and rows that repeat an id are
treated one by one; an empty table gives an empty one; other columns pass
through whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import cut, fresh

#: Forms of address and titles: fixed word lists, feminine, masculine and either.
FEMININE = ("Mrs", "Ms", "Miss", "Mme", "Madame", "Mlle", "Frau", "Sra", "Señora", "Srta", "Doña", "Signora", "г-жа", "госпожа")
MASCULINE = ("Mr", "Mister", "Monsieur", "Herr", "Herrn", "Señor", "Don", "Signor", "г-н", "господин")
TITLES = ("Dr", "Prof", "Professor", "Doctor", "Dra", "Docteur", "Doktor", "доктор")
_ADDRESS = "|".join((*FEMININE, *MASCULINE, *TITLES))

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"\p{Lu}[\p{Ll}\p{M}'’-]+"
_FORMS = rf"(?<!\p{{L}})(?:{_ADDRESS})\.?\s(?:(?:{_ADDRESS})\.?\s)?(?:{_NAME})(?: {_NAME})?"
#: What a credential is made of; parts of a dotted one and closing signs belong to it.
_CREDENTIAL = r"[A-Za-z0-9_/+-]"
#: Type -> Java pattern; a mention is the text that the pattern takes, context stands in look-arounds.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]++@[\p{L}\p{M}\p{N}-]+(?:\.[\p{L}\p{M}\p{N}-]+)*\.[\p{L}\p{M}]{2,24}(?![\p{L}\p{N}])",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\d]|\.\d)",
    "phone": r"(?<![\p{L}\p{N}+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\d)"
    r"|(?<![\p{L}\p{N}(])\(\d{3}\) ?\d{3}[.-]\d{4}(?!\d)|(?<![\p{L}\p{N}.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d.-]\d|\d)",
    "card": r"(?<![\d.,-])\d(?:[ -]?\d){12,18}(?!\d)",
    "ssn": r"(?<![\d-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\d-])",
    "secret": rf"(?<!{_CREDENTIAL})(?={_CREDENTIAL}{{16}})"
    r"(?<=(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\x22']?\s{0,2}[=:]\s{0,2}[\x22']?)"
    rf"{_CREDENTIAL}++(?:\.{_CREDENTIAL}++)*+=*+"
    r"|(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36})(?![A-Za-z0-9])",
    "name": rf"(?<=(?<!\p{{L}})(?:{_ADDRESS})\.?\s)(?!(?:{_ADDRESS})\.?\s\p{{Lu}})(?:{_NAME})(?: {_NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Cheap test that every text with a mention passes.
HINT = rf"[@0-9]|(?<!\p{{L}})(?:{_ADDRESS})\.?\s|(?i:token|secret|passw|key)"
#: A format is dense if the corpus holds more than this share of its values.
DENSE = 0.25
#: After so many draws in vain a mail address or a credential becomes longer, for formats that are narrower than they look.
LENGTHEN = 12


def _type_of(raw: Column) -> Column:
    """Type of a mention; the patterns are disjoint in these signs."""
    digits = F.regexp_replace(raw, r"[^0-9]", "")
    return (
        F.when(raw.contains("@"), "email")
        .when(raw.rlike(rf"^{PATTERNS['ip']}$"), "ip")
        .when(raw.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(raw.rlike(r"^\+|^\(|^\d{3}[.-]\d{3}[.-]\d{4}$"), "phone")
        .when(raw.rlike(r"^\d[\d -]*$") & F.length(digits).between(13, 19), "card")
        .when(raw.rlike(rf"^{_NAME}(?: {_NAME})?$"), "name")
        .when(raw.rlike(r"^[\p{Lu}\p{M}'’-]+(?: [\p{Lu}\p{M}'’-]+)?$") & ((F.length(raw) < 16) | raw.contains(" ")), "name")
        .otherwise("secret")
    )


def _luhn(digits: Column) -> Column:
    """Sum of the check-digit rule of card numbers."""
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    return F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int"))),
        F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)),
    )


def _with_names(docs: DataFrame, row: str, pattern: str) -> DataFrame:
    """``docs`` with a column ``pattern``: every kind of mention, and the bare names and parts of names of this text.

    Known are names after a form of address. A bare mention is a known full name, or a known part of
    one, between non-letters.
    """
    address = rf"^(?:(?:{_ADDRESS})\.?\s)+"
    found = F.expr(f"regexp_extract_all(text, r\"{_FORMS}\", 0)")
    names = F.transform(found, lambda x: F.regexp_replace(x, address, ""))
    parts = F.array_distinct(F.flatten(F.transform(names, lambda x: F.split(x, " "))))
    parts = F.array_distinct(F.concat(parts, F.transform(parts, lambda x: F.upper(x))))
    # Letters, apostrophes and hyphens only, so nothing has to be quoted.
    bare = F.concat(F.lit(r"|(?<!\p{L})(?:"), F.array_join(parts, "|"), F.lit(")(?: (?:"), F.array_join(parts, "|"), F.lit(r"))?(?![\p{L}'’-])"))
    some = F.coalesce(F.size(parts) > 0, F.lit(False)) & F.coalesce(F.col("text").rlike(_FORMS), F.lit(False))
    return docs.withColumn(pattern, F.when(some, F.concat(F.lit(ANY), bare)).otherwise(F.lit(ANY)))


def mentions(docs: DataFrame, row: str, pattern: str) -> DataFrame:
    """``row, pos, raw, kind, canonical`` of every mention; those that are no entity have no kind."""
    found = docs.select(row, F.posexplode(F.regexp_extract_all("text", F.col(pattern), F.lit(0))).alias("pos", "raw"))
    found = found.withColumn("kind", _type_of(F.col("raw")))
    digits = F.regexp_replace("raw", r"[^0-9]", "")
    wrong_card = (F.col("kind") == "card") & (_luhn(digits) % 10 != 0)
    fixed = ~F.coalesce(F.regexp_replace("raw", r"\.[^.@]+$", "").rlike(r"[\p{L}\p{N}]"), F.lit(False)) & F.col("kind").isin("email", "secret")
    found = found.withColumn("kind", F.when(~wrong_card & ~fixed, F.col("kind")))
    national = F.when(F.col("raw").rlike(r"^\+1(?!\d{1,2}[ .(-])") & (F.length(digits) == 11), F.substring(digits, 2, 10)).otherwise(digits)
    canonical = (
        F.when(F.col("kind") == "phone", national)
        .when(F.col("kind").isin("card", "ssn"), digits)
        .when(F.col("kind").isin("email", "name"), F.lower("raw"))
        .otherwise(F.col("raw"))
    )
    return found.withColumn("canonical", canonical)


def _stream(key: str, kind: Column, canonical: Column, attempt: Column, length: Column) -> Column:
    """Hexadecimal digits drawn for an entity, at least two for each of its characters."""
    seed = F.concat_ws("|", F.lit(key), kind, canonical, attempt.cast("string"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor(length / 32).cast("int")), lambda j: F.sha2(F.concat_ws("|", F.lit(key), F.sha2(F.concat_ws("|", seed, j.cast("string")), 256)), 256))
    return F.array_join(blocks, "")


def _drawn(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, (2 * i + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


_DIGIT, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Letters by script, in pairs of lower and upper case alike; fixed values.
_SCRIPTS = (
    ("[a-z]", "abcdefghijklmnopqrstuvwxyz"),
    ("[A-Z]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("[ß-öø-ÿ]", "àâäçèéêëîïñóôöùûüí"),
    ("[À-ÖØ-Þ]", "ÀÂÄÇÈÉÊËÎÏÑÓÔÖÙÛÜÍ"),
    ("[а-яё]", "абвгдежзиклмнопрстуфхцч"),
    ("[А-ЯЁ]", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧ"),
    ("[α-ω]", "αβγδεζηθικλμνξοπρστυφχψω"),
    ("[Α-Ω]", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
    (r"\p{IsHan}", "安白陈方高国海华江金李林明宁平青山田王文吴小新云张中"),
    (r"[\p{IsHebrew}&&\p{L}]", "אבגדהוזחטיכלמנסעפצקרשת"),
    (r"[\p{IsArabic}&&\p{L}]", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"),
    (r"[\p{IsDevanagari}&&\p{L}]", "अआइईउएकखगघचछजटडतथदधनपबभमयरलवसह"),
    (r"[\p{IsThai}&&\p{L}]", "กขคงจชซดตทธนบปผพฟมยรลวสหอ"),
    (r"[\p{IsHangul}&&\p{L}]", "가나다라마바사아자차카타파하강김민박서수영이정지최한"),
    (r"[\p{IsHiragana}&&\p{L}]", "あいうえおかきくけこさしすせそたちつてとなにぬねの"),
    (r"[\p{IsKatakana}&&\p{L}]", "アイウエオカキクケコサシスセソタチツテトナニヌネノ"),
    (r"\p{Lu}", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (r"\p{L}", "abcdefghijklmnopqrstuvwxyz"),
    (r"\p{N}", "0123456789"),
)


def _letters(canonical: Column, stream: Column, hexadecimal: Column) -> Column:
    """Character by character: digits for digits, letters of the same script and case for letters."""

    def one(c: Column, i: Column) -> Column:
        n = _drawn(stream, i)
        out = F.when(hexadecimal & c.rlike("[a-f]"), F.substring(F.lit("abcdef"), n % 6 + 1, F.lit(1)))
        out = out.when(hexadecimal & c.rlike("[A-F]"), F.substring(F.lit("ABCDEF"), n % 6 + 1, F.lit(1)))
        out = out.when(c.rlike("[0-9]"), (n % 10).cast("string"))
        for pattern, alphabet in _SCRIPTS:
            out = out.when(c.rlike(pattern), F.substring(F.lit(alphabet), n % len(alphabet) + 1, F.lit(1)))
        return out.otherwise(c)

    return F.array_join(F.transform(F.split(canonical, ""), one), "")


#: Name parts by script and gender; fixed values.
_GIVEN = {
    "latin_f": "anna clara elena emma eva ines julia laura lea lucia maria marta nina nora paula sara sofia teresa vera viola".split(),
    "latin_m": "adam albert bruno carl daniel david emil felix hugo ivan jan leon lucas marco martin oscar paul peter robert simon".split(),
    "cyrillic_f": "анна вера галина дарья елена ирина лидия мария нина ольга".split(),
    "cyrillic_m": "антон борис вадим глеб денис егор иван лев марк олег".split(),
}
_SYLLABLES = {
    "latin": "bar bel cor dan del fer gar hal kel lan lor mar mon nor per ral ros san tar tor val ver wil".split(),
    "cyrillic": "бар бел вол гор дан зай кал кор лан лом мар мор нов пол рос сав сол тар тур фед".split(),
}
_ENDINGS = {"latin_f": "ina", "latin_m": "o", "cyrillic_f": "ина", "cyrillic_m": "ий"}


def _pick(words: list[str], n: Column) -> Column:
    return F.element_at(F.lit(words), n % len(words) + 1)


def _syllables(script: str, count: Column, stream: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(1), count.cast("int")), lambda j: _pick(_SYLLABLES[script], _drawn(stream, j))), "")


def _given(canonical: Column, feminine: Column, stream: Column, attempt: Column) -> Column:
    """A given name of the script and gender; from the second attempt on one made of syllables."""
    first = _drawn(stream, F.lit(0))

    def of(script: str) -> Column:
        listed = F.when(feminine, _pick(_GIVEN[f"{script}_f"], first)).otherwise(_pick(_GIVEN[f"{script}_m"], first))
        ending = F.when(feminine, _ENDINGS[f"{script}_f"]).otherwise(_ENDINGS[f"{script}_m"])
        return F.when(attempt < 1, listed).otherwise(F.concat(_syllables(script, F.floor(attempt / 2) + 2, stream), ending))

    return F.when(canonical.rlike("[а-яё]"), of("cyrillic")).otherwise(of("latin"))


def _family(canonical: Column, feminine: Column, stream: Column, attempt: Column) -> Column:
    """A family name of syllables, more of them with each attempt."""
    count = F.lit(3) + F.floor(attempt / 2)
    cyrillic = F.concat(_syllables("cyrillic", count, stream), F.when(feminine, F.lit("ова")).otherwise(F.lit("ов")))
    return F.when(canonical.rlike("[а-яё]"), cyrillic).otherwise(_syllables("latin", count, stream))


_PRIVATE = r"^(192\.168|172\.(1[6-9]|2\d|3[01])|169\.254)\."


def _draw(entities: DataFrame, key: str, attempt: int) -> DataFrame:
    """``entities(kind, canonical, feminine)`` with this attempt's ``surrogate``."""
    kind, canonical, tries = F.col("kind"), F.col("canonical"), F.lit(attempt)
    stream = _stream(key, kind, canonical, tries, F.length(canonical))
    hexadecimal = (kind == "secret") & canonical.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
    plain = _letters(canonical, stream, hexadecimal)
    if attempt >= LENGTHEN:
        more = F.translate(F.substring(F.sha2(stream, 256), F.lit(1), F.lit(attempt // LENGTHEN)), _DIGIT, "ghijklmnop")
        plain = F.when(kind.isin("email", "secret"), F.concat(more, plain)).otherwise(plain)
    df = entities.withColumn("_plain", plain)
    # A mail address keeps its top-level domain; a card its first digit, and the last one makes the check sum right.
    df = df.withColumn("_domain", F.regexp_extract(canonical, r"\.[^.@]+$", 0))
    df = df.withColumn("_body", F.concat(F.substring(canonical, 1, 1), F.expr("substring(_plain, 2, length(canonical) - 2)")))
    octet = lambda i: (_drawn(stream, F.lit(i)) % 254 + 1).cast("string")
    own = F.split(canonical, r"\.")
    head = _drawn(stream, F.lit(0)) % 115 + 11
    by_kind = {
        "email": F.expr("concat(substring(_plain, 1, length(_plain) - length(_domain)), _domain)"),
        "card": F.concat(F.col("_body"), _check_digit(F.col("_body"))),
        # A telephone number keeps what stands before its last ten digits, and these begin with no 0 or 1.
        "phone": F.expr(
            "concat(substring(canonical, 1, greatest(length(canonical) - 10, 0)), "
            "translate(substring(_plain, greatest(length(canonical) - 10, 0) + 1, 1), '01', '23'), "
            "substring(_plain, greatest(length(canonical) - 10, 0) + 2, 99))"
        ),
        "ssn": F.expr(
            "concat(translate(substring(_plain, 1, 1), '069', '234'), substring(_plain, 2, 2), "
            "translate(substring(_plain, 4, 2), '0', '7'), translate(substring(_plain, 6, 4), '0', '8'))"
        ),
        "ip": F.when(canonical.rlike(r"^(10|127)\."), F.concat_ws(".", own[0], octet(1), octet(2), octet(3)))
        .when(canonical.rlike(_PRIVATE), F.concat_ws(".", own[0], own[1], octet(2), octet(3)))
        .otherwise(F.concat_ws(".", (head + F.when(head >= 127, 1).otherwise(0)).cast("string"), octet(1), octet(2), octet(3))),
        "given": _given(canonical, F.col("feminine"), stream, tries),
        "family": _family(canonical, F.col("feminine"), stream, tries),
    }
    value = reduce(lambda w, x: w.when(kind == x[0], x[1]), by_kind.items(), F.when(F.lit(False), F.lit(None).cast("string")))
    return df.select("kind", "canonical", "feminine", value.otherwise(F.col("_plain")).alias("surrogate"))


def _check_digit(body: Column) -> Column:
    return ((10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")


def _shape(kind: Column, canonical: Column) -> Column:
    """The format of a value: changing characters as 0, a and A, others as they are.

    Of an address the whole numbers of its private range count, of a card the digits between first and
    last, of a mail address what stands before its top-level domain.
    """
    domain = F.regexp_extract(canonical, r"\.[^.@]+$", 0)
    masked = lambda c: F.translate(F.translate(F.translate(c, _DIGIT, "0" * 10), _LOWER, "a" * 26), _UPPER, "A" * 26)
    return (
        F.when(kind == "ip", F.coalesce(F.nullif(F.regexp_extract(canonical, _PRIVATE, 0), F.lit("")), F.nullif(F.regexp_extract(canonical, r"^(10|127)\.", 0), F.lit("")), F.lit("")))
        .when(kind == "card", F.concat(F.substring(canonical, 1, 1), F.length(canonical).cast("string")))
        .when(kind == "phone", F.expr("concat(substring(canonical, 1, greatest(length(canonical) - 10, 0)), '+', least(length(canonical), 10))"))
        .when(kind == "ssn", F.lit("ssn"))
        .when(kind == "email", F.concat(masked(F.expr("substring(canonical, 1, length(canonical) - length(regexp_extract(canonical, '[.][^.@]+$', 0)))")), domain))
        .otherwise(masked(canonical))
    )


def _space(kind: Column, shape: Column) -> Column:
    """How many values a format has, as a double."""
    count = lambda c: F.length(F.regexp_replace(shape, f"[^{c}]", "")).cast("double")
    return (
        F.when(kind == "ip", F.pow(F.lit(256.0), F.lit(4) - F.size(F.split(shape, r"\.")) + 1))
        .when(kind == "card", F.pow(F.lit(10.0), F.substring(shape, 2, 9).cast("double") - 2))
        .when(kind == "phone", F.pow(F.lit(10.0), F.element_at(F.split(shape, r"\+"), 2).cast("double")))
        .when(kind == "ssn", F.lit(1e9))
        .when(kind.isin("given", "family"), F.lit(float("inf")))
        .otherwise(F.pow(F.lit(10.0), count("0")) * F.pow(F.lit(26.0), count("aA")))
    )


def _changing(kind: Column, canonical: Column, shape: Column) -> Column:
    """Per changing position ``(number, radix)`` of a value of a dense format."""
    digit = lambda c: F.struct(c.cast("long").alias("d"), F.lit(10).cast("long").alias("r"))

    def symbol(c: Column) -> Column:
        letter = F.struct((F.ascii(F.lower(c)) - 97).cast("long").alias("d"), F.lit(26).cast("long").alias("r"))
        return F.when(c.rlike("[0-9]"), digit(c)).when(c.rlike("[a-zA-Z]"), letter)

    octets = F.slice(F.split(canonical, r"\."), F.size(F.split(shape, r"\.")), F.lit(4))
    part = (
        F.when(kind == "card", F.expr("substring(canonical, 2, length(canonical) - 2)"))
        .when(kind == "phone", F.expr("substring(canonical, greatest(length(canonical) - 10, 0) + 1, 99)"))
        .when(kind == "email", F.expr("substring(canonical, 1, length(canonical) - length(regexp_extract(canonical, '[.][^.@]+$', 0)))"))
        .otherwise(canonical)
    )
    return F.when(kind == "ip", F.transform(octets, lambda o: F.struct(o.cast("long").alias("d"), F.lit(256).cast("long").alias("r")))).otherwise(
        F.filter(F.transform(F.split(part, ""), symbol), lambda x: x.isNotNull())
    )


def _feistel(at: Column, a: Column, b: Column, key: str, shape: Column, back: bool) -> Column:
    """A keyed permutation of the numbers below ``a * b``: six rounds that add to one half a hash of the other."""
    left, right = F.expr("0L") + at % a, F.floor(at / a).cast("long")
    for k in reversed(range(6)) if back else range(6):
        noise = lambda half: F.xxhash64(F.lit(f"{key}|{k}"), shape, half)  # noqa: E731, B023
        sign = -1 if back else 1
        if k % 2 == 0:
            left = F.pmod(left + sign * F.pmod(noise(right), a), a)
        else:
            right = F.pmod(right + sign * F.pmod(noise(left), b), b)
    return right * a + left


def _next(entities: DataFrame, key: str) -> DataFrame:
    """``kind, canonical, surrogate`` of values of dense formats: the next valid one on the format's keyed cycle."""
    kind, canonical, shape = F.col("kind"), F.col("canonical"), F.col("shape")
    df = entities.withColumn("changing", _changing(kind, canonical, shape))
    df = df.withColumn("at", F.aggregate("changing", F.lit(0).cast("long"), lambda n, x: n * x["r"] + x["d"]))
    df = df.withColumn("n", F.aggregate("changing", F.lit(1).cast("long"), lambda n, x: n * x["r"]))
    df = df.withColumn("a", F.ceil(F.sqrt(F.col("n").cast("double"))).cast("long"))
    df = df.withColumn("b", F.ceil(F.col("n") / F.col("a")).cast("long"))
    done = None
    while True:
        whole = F.col("a") * F.col("b")
        df = df.withColumn("at", _feistel(F.col("at"), F.col("a"), F.col("b"), key, shape, True))
        df = df.withColumn("at", _feistel(F.pmod(F.col("at") + 1, whole), F.col("a"), F.col("b"), key, shape, False))
        # The number in the symbols of the format, last position first.
        made = F.aggregate(
            F.reverse("changing"), F.struct(F.col("at").alias("rest"), F.array().cast("array<long>").alias("out")),
            lambda s, x: F.struct(F.floor(s["rest"] / x["r"]).cast("long").alias("rest"), F.concat(F.array(s["rest"] % x["r"]), s["out"]).alias("out")),
            lambda s: s["out"],
        )
        df = df.withColumn("made", made)
        text = F.array_join(F.transform("made", lambda d: d.cast("string")), "")
        filled = F.aggregate(
            F.split(F.when(kind == "email", F.regexp_replace(canonical, r"\.[^.@]+$", "")).otherwise(canonical), ""),
            F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
            lambda s, c: F.when(
                c.rlike("[0-9a-zA-Z]"),
                F.struct(
                    F.concat(
                        s["out"],
                        F.when(c.rlike("[0-9]"), F.element_at("made", s["at"]).cast("string")).otherwise(
                            F.substring(F.when(c.rlike("[a-z]"), F.lit(_LOWER)).otherwise(F.lit(_UPPER)), (F.element_at("made", s["at"]) + 1).cast("int"), F.lit(1))
                        ),
                    ).alias("out"),
                    (s["at"] + 1).alias("at"),
                ),
            ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
            lambda s: s["out"],
        )
        value = (
            F.when(kind == "ip", F.concat(shape, F.array_join("made", ".")))
            .when(kind == "card", F.concat(F.substring(canonical, 1, 1), text, _check_digit(F.concat(F.substring(canonical, 1, 1), text))))
            .when(kind == "phone", F.concat(F.expr("substring(canonical, 1, greatest(length(canonical) - 10, 0))"), text))
            .when(kind == "ssn", text)
            .when(kind == "email", F.concat(filled, F.regexp_extract(canonical, r"\.[^.@]+$", 0)))
            .otherwise(filled)
        )
        valid = (F.col("at") < F.col("n")) & F.when(kind == "ssn", text.rlike(r"^(?!000|666|9)\d{3}(?!00)\d{2}(?!0000)\d{4}$")).when(
            kind == "ip", value.rlike(rf"^{_PRIVATE[1:]}|^(10|127)\.") == canonical.rlike(rf"^{_PRIVATE[1:]}|^(10|127)\.")
        ).otherwise(F.lit(True))
        df = cut(df.withColumn("surrogate", F.when(valid, value)), "cycle")
        good = df.filter("surrogate is not null").select("kind", "canonical", "surrogate")
        done = good if done is None else done.unionByName(good)
        df = df.filter("surrogate is null").drop("surrogate", "made")
        if df.isEmpty():
            return done


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind, canonical, surrogate`` of distinct entities, free of collisions.

    In formats that are not dense each round keeps a draw that no other entity made (of equal draws that
    of the least canonical form) and that no entity of the corpus has as its own value; the others draw
    again. At most a quarter of a format's values is taken by the corpus and a quarter by surrogates, so
    every round settles half of what is left, or more.
    """
    shaped = cut(entities.withColumn("shape", _shape(F.col("kind"), F.col("canonical"))), "shaped")
    counts = shaped.groupBy("kind", "shape").count().filter(F.col("count") > DENSE * _space(F.col("kind"), F.col("shape")))
    # One value of a format alone has itself only.
    counts = cut(counts.filter(_space(F.col("kind"), F.col("shape")) > 1), "dense")
    dense = shaped.join(counts.select("kind", "shape"), ["kind", "shape"], "left_semi")
    rest = shaped.join(counts.select("kind", "shape"), ["kind", "shape"], "left_anti").drop("shape")
    done = _next(dense, key) if not counts.isEmpty() else None
    taken = entities.select("kind", F.col("canonical").alias("surrogate"))
    attempt = 0
    while True:
        drawn = cut(_draw(rest, key, attempt), "drawn")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical"))
        good = first.join(taken, ["kind", "surrogate"], "left_anti")
        if done is not None:
            good = good.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        good = cut(good.select("kind", "canonical", "surrogate"), "surrogates")
        done = good if done is None else done.unionByName(good)
        rest = drawn.drop("surrogate").join(good.select("kind", "canonical"), ["kind", "canonical"], "left_anti")
        rest = cut(rest, "rest")
        attempt += 1
        if rest.isEmpty():
            return done


def _formatted(raw: Column, surrogate: Column, kind: Column) -> Column:
    """The surrogate in the format and case of the mention; digits fill it from the right, a country code before them stays."""
    extra = F.greatest(F.length(F.regexp_replace(raw, "[^0-9]", "")) - F.length(surrogate), F.lit(0))
    filled = F.aggregate(
        F.split(raw, ""),
        F.struct(F.lit("").alias("out"), (F.lit(1) - extra).alias("at")),
        lambda a, c: F.when(
            c.rlike("[0-9]"),
            F.struct(F.concat(a["out"], F.when(a["at"] < 1, c).otherwise(F.substring(surrogate, a["at"], F.lit(1)))).alias("out"), (a["at"] + 1).alias("at")),
        ).otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["at"].alias("at"))),
        lambda a: a["out"],
    )
    upper = (F.upper(raw) == raw) & (F.lower(raw) != raw)
    cased = F.when(upper, F.upper(surrogate)).otherwise(surrogate)
    return (
        F.when(kind.isin("phone", "card", "ssn"), filled)
        .when(kind == "email", cased)
        .when(kind.isin("given", "family"), F.when(upper, F.upper(surrogate)).otherwise(F.initcap(surrogate)))
        .otherwise(surrogate)
    )


def _name_parts(found: DataFrame, docs: DataFrame, row: str) -> DataFrame:
    """``found`` with names taken apart: ``row, pos, part, raw, kind, canonical``, kind given or family.

    The first of two words is the given name. A single word is a given name if the text has it as the
    first of two, and a family name otherwise.
    """
    words = F.split("raw", " ")
    exploded = found.filter("kind = 'name'").select(
        "row", "pos", F.size(words).alias("words"), F.posexplode(words).alias("part", "raw")
    ).withColumn("canonical", F.lower("raw"))
    firsts = exploded.filter("words = 2 and part = 0").select("row", "canonical").distinct().withColumn("first", F.lit(True))
    lasts = exploded.filter("words = 2 and part = 1").select("row", "canonical").distinct().withColumn("last", F.lit(True))
    named = exploded.join(firsts, ["row", "canonical"], "left").join(lasts, ["row", "canonical"], "left")
    given = F.when(F.col("words") == 2, F.col("part") == 0).otherwise(F.col("first").isNotNull() & F.col("last").isNull())
    named = named.select("row", "pos", "part", "raw", F.when(given, "given").otherwise("family").alias("kind"), "canonical")
    other = found.filter("kind is null or kind != 'name'").select("row", "pos", F.lit(0).alias("part"), "raw", "kind", "canonical")
    return named.unionByName(other)


def pseudonymise(docs: DataFrame, key: str, count: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text``; ``count`` names a further column with the number of replacements.

    ``key`` is the secret that surrogates depend on; whoever has it and a list of candidates can link them.
    """
    columns = docs.columns
    row, n, made, pattern = (fresh(docs, x) for x in ("row", "n_replaced", "replacements", "pattern"))
    hit = F.coalesce(F.col("text").rlike(HINT) & F.col("text").rlike(ANY), F.lit(False))
    touched = cut(docs.filter(hit).withColumn(row, F.monotonically_increasing_id()), "mentioned")
    with_names = _with_names(touched, row, pattern)
    found = mentions(with_names, row, pattern).withColumnRenamed(row, "row")
    found = cut(_name_parts(cut(found, "mentions"), touched, row), "mentions")
    gender = _feminine_names(touched)
    entities = found.filter("kind is not null").groupBy("kind", "canonical").agg(F.count(F.lit(1)).alias("times"))
    entities = entities.join(gender, ["kind", "canonical"], "left").select("kind", "canonical", F.coalesce("feminine", F.lit(False)).alias("feminine"))
    table = surrogates(cut(entities, "entities"), key)
    placed = found.join(table, ["kind", "canonical"], "left").select(
        "row", "pos", "part",
        F.coalesce(_formatted(F.col("raw"), F.col("surrogate"), F.col("kind")), F.col("raw")).alias("put"),
        F.when(F.col("part") == 0, F.col("surrogate").isNotNull().cast("int")).otherwise(0).alias("one"),
    )
    by_row = placed.groupBy("row").agg(  # the mentions of one text
        F.array_sort(F.collect_list(F.struct("pos", "part", "put"))).alias("all"), F.sum("one").alias(n)
    )
    # The parts of a name stand in one gap, with a space between them.
    joined_parts = F.aggregate(
        "all", F.array().cast("array<string>"),
        lambda out, x: F.when(x["part"] == 0, F.concat(out, F.array(x["put"]))).otherwise(
            F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(F.concat(F.element_at(out, -1), F.lit(" "), x["put"])))
        ),
    )
    by_row = by_row.select(F.col("row").alias(row), joined_parts.alias(made), n)
    joined = with_names.join(by_row, row, "left")
    gaps = F.split("text", F.col(pattern), F.lit(-1))
    text = F.array_join(F.zip_with(gaps, F.coalesce(made, F.array().cast("array<string>")), lambda g, p: F.concat(g, F.coalesce(p, F.lit("")))), "")
    changed = joined.withColumn("text", text).withColumn(n, F.coalesce(n, F.lit(0)).cast("long"))
    same = docs.filter(~hit).withColumn(n, F.lit(0).cast("long"))
    both = changed.select(*columns, n).unionByName(same.select(*columns, n))
    return both.select(*columns, *([F.col(n).alias(count)] if count else []))


def _feminine_names(docs: DataFrame) -> DataFrame:
    """``kind, canonical, feminine``: whether a part of a name stands after feminine forms of address more than after masculine ones."""
    seen = docs.select(F.explode(F.expr(f"regexp_extract_all(text, r\"{_FORMS}\", 0)")).alias("x"))
    form = F.regexp_extract("x", rf"^({_ADDRESS})\.?\s", 1)
    score = F.when(form.isin(list(FEMININE)), 1).when(form.isin(list(MASCULINE)), -1).otherwise(0)
    words = F.split(F.lower(F.regexp_replace("x", rf"^(?:(?:{_ADDRESS})\.?\s)+", "")), " ")
    parts = seen.select(score.alias("s"), F.size(words).alias("words"), F.posexplode(words).alias("part", "canonical"))
    parts = parts.withColumn("kind", F.explode(F.when(F.col("words") == 1, F.array(F.lit("given"), F.lit("family"))).when(F.col("part") == 0, F.array(F.lit("given"))).otherwise(F.array(F.lit("family")))))
    return parts.groupBy("kind", "canonical").agg((F.sum("s") > 0).alias("feminine"))
