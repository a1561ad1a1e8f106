"""Operator 3, PII: surrogate generation [native].

Addresses, numbers, secrets and titled names are found by one pattern. Each entity gets a surrogate of its own type
from a keyed hash: digits stand for digits and letters for letters of the same case, punctuation stays, card
numbers keep their check digit right, names keep their gender (by title and ending) and script, phone numbers
their country code, e-mail goes to reserved domains, IPv4 to the private range 10/8 and IPv6 to 2001:db8::/32. A name's
words get their surrogates one by one, by gender and script, so that "Mr John Smith" and "Mr Smith" agree. The surrogate depends on the entity alone, so all its mentions,
however they are written, agree in all documents. Surrogates are checked: two entities of one type must not share
one, and none may be an entity of the table; those that fail are hashed again until all are distinct. Within secrets
every character is replaced, signs and other scripts too. After ``WIDEN`` attempts surrogates become longer, or come
from a larger range, so that there are always enough of them, however few characters an entity has.

Defined results: null text stays null; empty texts and texts without entities stay as they are; null and repeated
ids are allowed, rows equal in id and text are treated alike; an empty table gives an empty result; other columns
stay as they are, but for ``n_entities``, which is added or replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import guarded, marked, stored

KEY = "surrogates-1"
#: Titles by gender and script; a title with one or two capitalised words after it is a person.
TITLES = {("m", "latin"): "Mr|Herr|Monsieur|Señor|Sr", ("f", "latin"): "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra",
          ("m", "cyrillic"): "г-н|господин", ("f", "cyrillic"): "г-жа|госпожа"}
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_WORD = r"\p{Lu}[\p{L}\-]*+"
_HEX = "[0-9A-Fa-f]{1,4}"
#: The countries of each length of IBAN.
IBANS = {15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV", 22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA",
         23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST", 26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM",
         28: "AL|AZ|BY|CY|DO|GT|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU"}
#: Country codes of the telephone of one and two digits; all others have three.
_CALLING = r"\A\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: Each type's pattern; none has a group. The first that fits at a place counts.
TYPES = {
    "email": r"(?<![\w.%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)+",
    "secret": r"(?<!\w)(?=[pstaPSTA])(?i:password|passwd|pwd|secret|token|api[_\-]?key)\s{0,3}[=:]\s{0,3}[\"']?[^\s\"',;]{6,}+",
    "access_key": r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)",
    "ipv4": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\w)",
    "ipv6": rf"(?<![\w:.])(?={_HEX}:)(?:(?:{_HEX}:){{7}}{_HEX}|(?=[A-Fa-f:]*+\d){_HEX}(?::{_HEX}){{0,5}}::{_HEX}(?::{_HEX}){{0,5}})(?![\w:]|\.\d)",
    "iban": rf"(?<!\w)(?=[A-Z]{{2}}\d\d)(?:{'|'.join(rf'(?:{c})(?: ?[A-Z0-9]){{{n - 2}}}' for n, c in IBANS.items())})(?!\w)",
    "phone": r"(?<![\w+])(?:(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\) ?|\d{3}[.\-])\d{3}[ .\-]?\d{4}|(?:1[ .\-])?\d{3} \d{3}[ .\-]?\d{4}"
             r"|1[ .\-]\d{3}[.\-]\d{3}[.\-]\d{4}|[2-9]\d{9}|\+[1-9](?:[ .\-]?\(?\d\)?){7,14})(?!\w)",
    "ssn": r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])",
    "card": r"(?<![\w\-])\d(?:[ \-]?\d){12,18}(?![\w\-])",
    "person": rf"(?<!\w)(?=[MHFSг])(?:{'|'.join(TITLES.values())})\.? {_WORD}(?: {_WORD})?",
}
#: No type begins within a word; one look at the character before keeps the types from being tried there.
PATTERN = rf"(?<!\w)(?:{'|'.join(TYPES.values())})"
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: What stands for characters of other kinds: their class and its alphabet; the last class holds all that are left.
_OTHERS = {"[а-яё]": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "[А-ЯЁ]": "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ", r"\p{Ll}": _LOWER, r"\p{Lu}": _UPPER,
           r"\p{N}": _DIGITS, r"\p{L}": "天地玄黃宇宙洪荒日月盈昃辰宿列張寒來暑往秋收冬藏閏餘成歲律呂調陽", ".": "!#$%&*+-./:=?@^_~"}
#: Attempts after which surrogates are drawn from a larger space.
WIDEN = 4
#: What names are made of, by script; the endings by gender.
SYLLABLES = {"latin": "ba be bo da de do fa fe ga ka ke la le lo ma me mo na ne no ra re ro sa so ta te to va ve vo za",
             "cyrillic": "ба бе бо да де до фа фе га ка ке ла ле ло ма ме мо на не но ра ре ро са со та те то ва ве во за"}
ENDINGS = {("m", "latin"): "lin", ("f", "latin"): "lina", ("m", "cyrillic"): "лин", ("f", "cyrillic"): "лина"}


def _chars(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def _luhn(digits: Column, extra: int = 0) -> Column:
    """The Luhn sum; with extra 1 that of the digits before a check digit."""
    d = F.reverse(_chars(digits))
    each = F.transform(d, lambda x, i: F.when((i + extra) % 2 == 0, x.cast("int")).otherwise(
        F.floor(x.cast("int") * 2 / 10).cast("int") + (x.cast("int") * 2) % 10))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _mod97(chars: Column) -> Column:
    """The rest modulo 97 of the number that an IBAN's characters spell, letters as 10 to 35."""
    value = lambda x: F.when(x.rlike("[A-Z]"), F.ascii(x) - 55).otherwise(x.cast("int"))
    return F.aggregate(chars, F.lit(0), lambda a, x: (a * F.when(x.rlike("[A-Z]"), 100).otherwise(10) + value(x)) % 97)


def _groups(address: Column) -> Column:
    """An IPv6 address in full: eight groups of four hexadecimal digits."""
    of = lambda c: F.filter(F.split(c, ":"), lambda x: x != "")
    left, right = of(F.substring_index(address, "::", 1)), of(F.when(address.contains("::"), F.substring_index(address, "::", -1)).otherwise(""))
    zeros = F.array_repeat(F.lit("0"), 8 - F.size(left) - F.size(right))
    return F.concat_ws(":", F.transform(F.concat(left, zeros, right), lambda x: F.lpad(x, 4, "0")))


def _type(found: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern in reversed(TYPES.items()):
        out = F.when(found.rlike(rf"\A(?:{pattern})\z"), name).otherwise(out)
    return out


_SECRET = r"(?s)\A(.*?[=:]\s{0,3}[\"']?)([^\s\"',;]+)\z"
_TITLE = rf"\A({'|'.join(TITLES.values())})\.? "


def entities(docs: DataFrame) -> DataFrame:
    """doc_id, row (hash of the text), pos, part, found, type and entity (the same for all spellings of one entity).

    What the pattern finds but a type's own test refuses (check digit) has type null. A person has a row (``part``)
    for each word, the first with the title; ``found`` of the parts in a row is the mention.
    """
    found = docs.select("doc_id", F.xxhash64("text").alias("row"),
                        F.posexplode(F.regexp_extract_all("text", F.lit(PATTERN), 0)).alias("pos", "found"))
    found = found.withColumn("type", _type(F.col("found"))).withColumn("digits", F.regexp_replace("found", r"\D", ""))
    t = F.col("type")
    signs = F.regexp_replace("found", " ", "")
    iban = _chars(F.concat(F.expr("substring(replace(found, ' ', ''), 5)"), F.substring(signs, 1, 4)))
    found = found.withColumn("type", F.when((t == "card") & (_luhn(F.col("digits")) % 10 != 0), F.lit(None))
                             .when((t == "iban") & (_mod97(iban) != 1), F.lit(None)).otherwise(t))
    gender = F.lit("m-latin")
    for (g, script), titles in TITLES.items():
        gender = F.when(F.col("found").rlike(rf"\A(?:{titles})\.? "), f"{g}-{script}").otherwise(gender)
    title, names = F.regexp_extract("found", _TITLE, 0), F.split(F.regexp_replace("found", _TITLE, ""), " ")
    mention = F.transform(names, lambda x, i: F.concat(F.when(i == 0, title).otherwise(" "), x))
    found = found.withColumn("kind", gender).select(
        "doc_id", "row", "pos", F.posexplode(F.when(t == "person", mention).otherwise(F.array("found"))).alias("part", "found"), "type", "digits", "kind")
    name = F.lower(F.trim(F.regexp_replace("found", _TITLE, "")))
    entity = (F.when(t == "email", F.lower("found"))
              .when(t == "secret", F.regexp_extract("found", _SECRET, 2))
              .when((t == "phone") & F.col("found").startswith("+"), F.concat(F.lit("+"), "digits"))
              .when(t.isin("phone", "card", "ssn"), F.col("digits"))
              .when(t == "person", F.concat_ws(" ", "kind", name))
              .when(t == "ipv6", _groups(F.lower("found")))
              .when(t == "iban", F.regexp_replace("found", " ", ""))
              .otherwise(F.col("found")))
    return found.withColumn("entity", entity).drop("digits", "kind")


def _stream(key: str) -> Column:
    """256 hexadecimal digits that the key, the entity and the attempt decide."""
    seed = F.concat_ws("|", F.lit(key), "type", "entity", F.col("attempt").cast("string"))
    return F.concat(*(F.sha2(F.concat(seed, F.lit(f"|{i}")), 256) for i in range(4)))


def _number(i: Column) -> Column:
    """The i-th number (16 bits) of the stream, in turn."""
    return F.conv(F.substring(F.col("stream"), (i % 64) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _pick(alphabet: str, i: Column) -> Column:
    return F.substring(F.lit(alphabet), (_number(i) % len(alphabet)) + 1, F.lit(1))


def _like(text: Column, hexadecimal: Column | None = None, first: int = 0, signs: bool = False) -> Column:
    """Other characters of the same kinds; with ``signs`` those of other scripts, signs and symbols too, else they
    stay. The first digit is not 0 or 1."""
    def other(x: Column, i: Column) -> Column:
        lower = _pick(_LOWER, i) if hexadecimal is None else F.when(hexadecimal, _pick("abcdef", i)).otherwise(_pick(_LOWER, i))
        out = (F.when(i < first, x).when(x.rlike("[0-9]"), F.when(i == first, _pick("23456789", i)).otherwise(_pick(_DIGITS, i)))
               .when(x.rlike("[a-z]"), lower).when(x.rlike("[A-Z]"), _pick(_UPPER, i)))
        for kind, alphabet in _OTHERS.items() if signs else ():
            out = out.when(x.rlike(f"(?s){kind}"), _pick(alphabet, i))
        return out.otherwise(x)
    return F.concat_ws("", F.transform(_chars(text), other))


def _more(digits: bool = False) -> Column:
    """What makes a surrogate longer after ``WIDEN`` attempts: 12 hexadecimal digits, or 8 decimal ones."""
    more = F.concat(*(_pick(_DIGITS, F.lit(40 + i)) for i in range(8))) if digits else F.substring(F.col("stream"), 201, 12)
    return F.when(F.col("attempt") >= WIDEN, more).otherwise("")


def _named() -> Column:
    """A name for each word of a name; gender and script are the first word of the entity."""
    parts = F.split("entity", " ")
    kind = parts[0]
    ending = F.lit("")
    for (g, script), end in ENDINGS.items():
        ending = F.when(kind == f"{g}-{script}", end).otherwise(ending)

    def word(i: Column) -> Column:
        def syllable(k: int) -> Column:
            at = _number(i * 16 + k) % 32
            return F.when(kind.endswith("cyrillic"), F.split(F.lit(SYLLABLES["cyrillic"]), " ")[at]).otherwise(F.split(F.lit(SYLLABLES["latin"]), " ")[at])
        longer = F.when(F.col("attempt") >= WIDEN, F.concat(*(syllable(k) for k in range(4, 12)))).otherwise("")
        return F.initcap(F.concat(*(syllable(k) for k in range(4)), longer, ending))

    return F.concat_ws(" ", F.transform(F.slice(parts, 2, 100), lambda _, i: word(i)))


def _surrogate() -> Column:
    t, e = F.col("type"), F.col("entity")
    hexadecimal = e.rlike(r"\A[0-9a-f]+\z")
    labels = F.split(F.substring_index(e, "@", -1), r"\.")
    n = F.size(labels)
    # a local part of signs alone gets letters; too few locals of one top-level domain get a host label each
    local = F.substring_index(e, "@", 1)
    local = F.when(local.rlike("[a-z0-9]"), _like(local)).otherwise(_like(F.regexp_replace(local, ".", "a")))
    widened = F.when(F.col("attempt") >= WIDEN, F.concat(F.lit("h"), _more(), F.lit("."))).otherwise("")
    host = F.concat_ws(".", F.transform(labels, lambda x, i: F.when(i == n - 1, x).when(i == n - 2, "example").otherwise(
        F.concat(F.lit("h"), F.substring(F.col("stream"), 1, F.lit(6))))))
    body = F.concat(_like(F.concat(F.substring(e, 1, 1), F.expr("substring(entity, 2, length(entity) - 2)")), first=1), _more(True))
    check = F.concat(body, ((10 - _luhn(body, 1) % 10) % 10).cast("string"))
    code = F.regexp_extract(e, _CALLING, 0)
    code = F.when(code == "", F.substring(e, F.lit(1), F.greatest(F.length(e) - 10, F.lit(0)))).otherwise(code)
    bank = _like(F.expr("substring(entity, 5)"))
    checked = F.lpad((98 - _mod97(_chars(F.concat(bank, F.substring(e, 1, 2), F.lit("00"))))).cast("string"), 2, "0")
    documented = F.concat_ws(":", F.lit("2001:db8"), *(F.substring(F.col("stream"), 4 * i + 1, 4) for i in range(6)))
    octets = [(_number(F.lit(i)) % 254 + 1).cast("string") for i in range(3)]
    # 10/8, then the reserved range 240/4, then an IPv6 range for documentation
    private = (F.when(F.col("attempt") < WIDEN, F.concat_ws(".", F.lit("10"), *octets))
               .when(F.col("attempt") < 2 * WIDEN, F.concat_ws(".", (_number(F.lit(3)) % 15 + 240).cast("string"), *octets))
               .otherwise(documented))
    return (F.when(t == "email", F.concat(local, F.lit("@"), widened, host))
            .when(t == "access_key", F.concat(F.lit("AKIA"), _like(F.expr("substring(entity, 5)"))))
            .when(t == "ipv4", private)
            .when(t == "ipv6", documented)
            .when(t == "iban", F.concat(F.substring(e, 1, 2), checked, bank))
            .when(t == "phone", F.concat(code, _like(F.substring(e, F.length(code) + 1, F.length(e))), _more(True)))
            .when(t == "ssn", F.concat(F.lit("9"), _like(F.expr("substring(entity, 2)")), _more(True)))
            .when(t == "card", check)
            .when(t == "person", _named())
            .otherwise(F.concat(_like(e, hexadecimal, signs=True), _more())))


def surrogates(found: DataFrame, key: str = KEY) -> DataFrame:
    """type, entity and surrogate of each entity: distinct, and none of them an entity itself."""
    table = stored(found.where("type IS NOT NULL").groupBy("type", "entity").agg(F.lit(0).alias("attempt")))
    plain = stored(table.select("type", F.when(F.col("type") == "person", F.substring_index("entity", " ", -1)).otherwise(F.col("entity")).alias("same")).distinct())
    while True:
        made = stored(table.withColumn("stream", _stream(key)).withColumn("surrogate", _surrogate()).drop("stream"))
        first = made.groupBy("type", "surrogate").agg(F.min("entity").alias("keeps"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        taken = plain.select("type", F.col("same").alias("surrogate"), F.lit(True).alias("taken"))
        tested = made.withColumn("lower", F.when(F.col("type") == "person", F.lower("surrogate")).otherwise(F.col("surrogate")))
        again = stored(tested.join(first, ["type", "surrogate"], "left")
                       .join(taken.withColumnRenamed("surrogate", "lower"), ["type", "lower"], "left")
                       .where((F.col("keeps") != F.col("entity")) | F.col("taken")).select("type", "entity", F.lit(1).alias("more")))
        if again.isEmpty():
            return made.select("type", "entity", "surrogate")
        table = stored(made.join(again, ["type", "entity"], "left").select(
            "type", "entity", (F.col("attempt") + F.coalesce("more", F.lit(0))).alias("attempt")))


def _written() -> Column:
    """The surrogate in the way the mention is written."""
    t, s = F.col("type"), F.regexp_replace("surrogate", r"\A\+", "")
    chars = _chars(F.col("found"))
    # the k-th digit of the mention becomes the k-th of the surrogate
    digit = lambda i: F.size(F.filter(F.slice(chars, 1, i + 1), lambda x: x.rlike("[0-9]")))
    filled = F.concat_ws("", F.transform(chars, lambda x, i: F.when(x.rlike("[0-9]"), F.substring(s, digit(i), F.lit(1))).otherwise(x)))
    filled = F.concat(filled, F.substring(s, F.length(F.regexp_replace("found", r"\D", "")) + 1, F.length(s)))  # a longer surrogate
    letter = lambda i: F.size(F.filter(F.slice(chars, 1, i + 1), lambda x: x != " "))
    spaced = F.concat_ws("", F.transform(chars, lambda x, i: F.when(x == " ", x).otherwise(F.substring(s, letter(i), F.lit(1)))))
    before = F.coalesce(F.nullif(F.regexp_extract("found", _TITLE, 0), F.lit("")), F.regexp_extract("found", r"\A ", 0))
    name = F.trim(F.regexp_replace("found", _TITLE, ""))
    cased = F.when((name == F.upper(name)) & (F.length(name) > 2), F.upper(s)).otherwise(s)
    return (F.when(t.isin("phone", "card", "ssn"), filled)
            .when(t == "secret", F.concat(F.regexp_extract("found", _SECRET, 1), s))
            .when(t == "person", F.concat(before, cased))
            .when(t == "iban", spaced)
            .when(t.isin("email", "ipv6") & (F.col("found") == F.upper("found")) & (F.col("found") != F.lower("found")), F.upper(s))
            .otherwise(F.coalesce(s, F.col("found"))))


def pseudonymised(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The documents with surrogates for all entities in ``text``, and n_entities."""
    docs, back = guarded(docs, ("doc_id", "text"), ("n_entities",))
    found = stored(entities(docs))
    s = surrogates(found, key).alias("s")
    f = found.alias("f")
    written = f.join(s, (F.col("f.type") == F.col("s.type")) & (F.col("f.entity") == F.col("s.entity")), "left").select(
        "f.doc_id", "f.row", "f.pos", "f.part", "f.found", "f.type", "s.surrogate")
    by = stored(written.select("doc_id", "row", "pos", "part", _written().alias("new"), F.col("type").isNotNull().cast("long").alias("one"))
                .groupBy("doc_id", "row", "pos").agg(F.array_sort(F.collect_set(F.struct("part", "new"))).alias("new"), F.max("one").alias("one"))
                .withColumn("new", F.concat_ws("", "new.new"))
                .groupBy("doc_id", "row").agg(F.array_sort(F.collect_list(F.struct("pos", "new"))).alias("new"), F.sum("one").alias("n")))
    names = docs.columns
    rows = marked(docs.withColumn("__row", F.xxhash64("text")), "__row", by.select(F.col("row").alias("key")), "__may")
    whole = rows.where(~F.col("__may")).select(*names, F.lit(0).cast("long").alias("n_entities"))
    r, b = rows.where("__may").alias("r"), by.alias("b")
    pieces = F.split("r.text", PATTERN, -1)
    text = F.concat_ws("", F.flatten(F.zip_with(pieces, F.col("b.new.new"), lambda p, n: F.array(p, F.coalesce(n, F.lit(""))))))
    cut = (r.join(b, (F.col("r.__row") == F.col("b.row")) & F.col("r.doc_id").eqNullSafe(F.col("b.doc_id")), "left")
           .select(*(F.when(F.col("b.new").isNull(), F.col("r.text")).otherwise(text).alias(c) if c == "text" else F.col(f"r.{c}") for c in names),
                   F.coalesce("b.n", F.lit(0)).cast("long").alias("n_entities")))
    return back(whole.unionByName(cut), "n_entities")
