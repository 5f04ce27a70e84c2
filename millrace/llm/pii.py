"""Personal data and secrets replaced by keyed surrogates of the same kind, all in DataFrame functions.

One pattern finds the entities of a text. Each distinct entity of the corpus gets one surrogate, a keyed
function of its kind and canonical form, so every mention in every document changes alike. A check over all
surrogates finds those that two entities share or that are an entity of the corpus themselves; these are
drawn again until none is left. Documents without entities take no part in joins or shuffles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import landed

# fixed values: titles before names, by gender
MALE = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "господин", "Господин"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "госпожа", "Госпожа"]
NEUTRAL = ["Dr", "Doctor", "Prof", "Professor", "Доктор", "Профессор"]
NAMES = ["male", "female", "first", "last"]
# fixed values: calling codes of one and two digits; all others have three
CALLING_CODE = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
# what makes the value after it a secret, in any case
LABEL = r"(?i:password|passwd|token|secret|api_key|apikey)[ \t]{0,3}[=:][ \t]{0,3}[\"']{0,1}"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# kinds in the order in which the pattern tries them
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "ip": rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?[0-9])",
    "phone": r"(?<![A-Za-z0-9+])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\) ?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])"
    r"|(?<![A-Za-z0-9+])\+[0-9]{1,3}[ .-]?[0-9]{1,4}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])"
    r"|(?<![A-Za-z0-9.-])[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}(?![0-9-])",
    "ssn": r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![A-Za-z0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "key": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    # what costs little is asked first: long look-behinds only where a value or a name can start
    "secret": rf"(?<=[=: \t\"'])(?=[A-Za-z0-9+/_-]{{12}})(?<={LABEL})[A-Za-z0-9+/_-]{{12,}}+",
    "name": rf"(?<=[ ])(?=\p{{Lu}})(?<=(?<![\p{{L}}])(?:{'|'.join(MALE + FEMALE + NEUTRAL)})\.?[ ])\p{{Lu}}[\p{{L}}]++(?:[ ]\p{{Lu}}[\p{{L}}]++){{0,2}}",
}
# what an entity can start with decides which kinds are tried; none starts within a word
STARTS = {
    r"[0-9(+]": ["email", "ip", "secret", "phone", "ssn", "card"],
    r"[A-Za-z\p{Lu}]": ["email", "key", "secret", "iban", "name"],
    r"[._%/-]": ["email", "secret"],
}
ANY = "(?<![A-Za-z0-9])(?:{})".format(
    "|".join(f"(?={start})(?:{'|'.join(f'(?:{PATTERNS[k]})' for k in kinds)})" for start, kinds in STARTS.items())
)
# syllables of a made-up name at the first attempt; each further attempt has one more
FEWEST = 5
# fixed values: syllables of made-up names by script; the last of each row is for female first names
SYLLABLES = {
    "latin": (["ba", "ro", "mi", "tel", "van", "sor", "lin", "dra", "ke", "no", "fa", "gri"], "ek", "ia"),
    "cyrillic": (["ба", "ро", "ми", "тел", "ван", "сор", "лин", "дра", "ке", "но", "фа", "гри"], "ек", "ия"),
    "greek": (["βα", "ρο", "μι", "τελ", "βαν", "σορ", "λιν", "δρα", "κε", "νο", "φα", "γρι"], "ος", "ια"),
}
MOST_ROUNDS = 40
DRAWN_BYTES = 64


def _kind(entity: Column, labelled: Column) -> Column:
    """The kind of a found string: the first format that it has as a whole, else a secret where it is labelled as one."""
    digits = F.regexp_replace(entity, "[^0-9]", "")
    return (
        F.when(entity.contains("@"), "email")
        .when(entity.rlike(rf"^(?:{OCTET}\.){{3}}{OCTET}$"), "ip")
        .when(entity.rlike(r"^AKIA[A-Z0-9]{16}$"), "key")
        .when(entity.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(entity.rlike(f"^(?:{PATTERNS['phone']})$"), "phone")
        .when(
            entity.rlike(r"^[0-9](?:[ -]?[0-9]){12,18}$"),
            F.when(_luhn(digits) % 10 == 0, "card").when(labelled, "secret"),
        )
        .when(entity.rlike(r"^[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?$"), "iban")
        .when(labelled, "secret")
        .when(entity.rlike(r"^\p{Lu}\p{L}+(?: \p{Lu}\p{L}+){0,2}$"), "name")
        .otherwise("secret")
    )


def _luhn(digits: Column) -> Column:
    """The sum of a number with its check digit, which is a multiple of ten for a valid one."""
    reverse = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    parts = F.transform(
        reverse,
        lambda c, i: F.when(i % 2 == 1, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(
            c.cast("int")
        ),
    )
    return F.aggregate(parts, F.lit(0), lambda a, b: a + b)


def _mod97(text: Column) -> Column:
    """What digits and capital letters (A is 10) leave when divided by 97 as one number."""
    characters = F.filter(F.split(text, ""), lambda c: c != "")

    def longer(rest: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), rest * 10 + F.ascii(c) - 48).otherwise(rest * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(characters, F.lit(0), longer)


def _canonical(kind: Column, entity: Column) -> Column:
    """What mentions of one entity agree in."""
    plain = F.regexp_replace(entity, "[ -]", "")
    return (
        F.when(kind.isin("phone", "ssn"), F.regexp_replace(entity, "[^0-9+]", ""))
        .when(kind.isin("card", "iban"), plain)
        .when(kind.isin("email", *NAMES), F.lower(entity))
        .otherwise(entity)
    )


def _drawn(hex_bytes: Column, at: Column | int) -> Column:
    """The number, 0 to 255, that the hash holds at a place."""
    place = (F.lit(at) if isinstance(at, int) else at) % DRAWN_BYTES
    return F.conv(hex_bytes.substr(place * 2 + F.lit(1), F.lit(2)), 16, 10).cast("int")


def _letter(alphabet: str, number: Column) -> Column:
    return F.substring(F.lit(alphabet), number % len(alphabet) + 1, F.lit(1))


def _shaped(canonical: Column, drawn: Column, fixed_head: Column, fixed_tail: Column) -> Column:
    """Digits for digits and letters for letters, but for a head and a tail that stay."""
    hexadecimal = canonical.rlike("^[0-9a-f]+$")
    letters = F.when(hexadecimal, F.lit("abcdef")).otherwise(F.lit("abcdefghijklmnopqrstuvwxyz"))
    size = F.length(canonical)

    def other(c: Column, i: Column) -> Column:
        n = _drawn(drawn, i)
        return (
            F.when((i < fixed_head) | (i >= size - fixed_tail), c)
            .when(c.rlike("[0-9]"), _letter("0123456789", n))
            .when(c.rlike("[a-z]"), F.substring(letters, n % F.length(letters) + 1, F.lit(1)))
            .when(c.rlike("[A-Z]"), _letter("ABCDEFGHIJKLMNOPQRSTUVWXYZ", n))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.filter(F.split(canonical, ""), lambda c: c != ""), other), "")


def _made_up_name(kind: Column, canonical: Column, drawn: Column, size: int) -> Column:
    def of(script: str) -> Column:
        syllables, male, female = SYLLABLES[script]
        table = F.array(*[F.lit(s) for s in syllables])
        parts = [F.element_at(table, _drawn(drawn, k) % len(syllables) + 1) for k in range(size)]
        ending = F.when(kind == "female", female).when(kind == "male", male).otherwise("")
        return F.concat(*parts, ending)

    return (
        F.when(canonical.rlike(r"\p{IsCyrillic}"), of("cyrillic"))
        .when(canonical.rlike(r"\p{IsGreek}"), of("greek"))
        .otherwise(of("latin"))
    )


def _surrogate(key: str, kind: Column, canonical: Column, attempt: int) -> Column:
    """The canonical surrogate of an entity: as long and of the same classes of characters where that is the format."""
    seed = F.concat_ws("|", F.lit(key), kind, canonical, F.lit(str(attempt)))
    drawn = F.concat(F.sha2(F.concat(seed, F.lit("|a")), 256), F.sha2(F.concat(seed, F.lit("|b")), 256))
    none = F.lit(0)
    octets = [(_drawn(drawn, k) % 254 + 1).cast("string") for k in range(4)]
    top_level = F.length(F.substring_index(canonical, ".", -1)) + 1
    card = _shaped(canonical, drawn, F.lit(1), none)
    body = F.substring(card, F.lit(1), F.length(card) - 1)
    check = ((10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")
    country = F.substring(canonical, F.lit(1), F.lit(2))
    account = F.regexp_replace(_shaped(canonical, drawn, F.lit(2), none), "^.{4}", "")
    control = F.lpad((98 - _mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0")
    code = F.length(F.regexp_extract(canonical, CALLING_CODE, 0))
    # short addresses have few surrogates of their shape; later attempts put letters before them
    grown = F.concat(*[_letter("abcdefghijklmnopqrstuvwxyz", _drawn(drawn, k)) for k in range(attempt - 2)]) if attempt > 2 else F.lit("")
    return (
        F.when(kind == "ip", F.concat_ws(".", *octets))
        .when(kind == "email", F.concat(grown, _shaped(canonical, drawn, none, top_level)))
        .when(kind == "card", F.concat(body, check))
        .when(kind == "phone", _shaped(canonical, drawn, code, none))
        .when(kind == "iban", F.concat(country, control, account))
        .when(kind == "key", _shaped(canonical, drawn, F.lit(4), none))
        .when(kind.isin(*NAMES), _made_up_name(kind, canonical, drawn, FEWEST + attempt))
        .otherwise(_shaped(canonical, drawn, none, none))
    )


def _rendered(kind: Column, entity: Column, surrogate: Column) -> Column:
    """The surrogate in the format of one mention: its separators and its case."""
    letters = F.filter(F.split(entity, ""), lambda c: c != "")
    # how many characters of the canonical form stand up to each place
    places = F.transform(F.sequence(F.lit(1), F.greatest(F.length(entity), F.lit(1))), lambda i: F.substring(entity, F.lit(1), i))
    spaced = F.array_join(
        F.transform(
            F.arrays_zip(letters.alias("c"), places.alias("p")),
            lambda x: F.when(
                x["c"].rlike("[A-Za-z0-9+]"),
                F.substring(surrogate, F.length(F.regexp_replace(x["p"], "[^A-Za-z0-9+]", "")), F.lit(1)),
            ).otherwise(x["c"]),
        ),
        "",
    )
    cased = F.array_join(
        F.transform(
            letters,
            lambda c, i: F.when(c.rlike("[A-Z]"), F.upper(F.substring(surrogate, i + 1, F.lit(1)))).otherwise(
                F.substring(surrogate, i + 1, F.lit(1))
            ),
        ),
        "",
    )
    named = F.when((F.upper(entity) == entity) & (F.length(entity) > 1), F.upper(surrogate)).otherwise(
        F.concat(F.upper(F.substring(surrogate, 1, 1)), F.expr("substring(surrogate, 2)"))
    )
    return (
        F.when(kind.isin("phone", "ssn", "card", "iban"), spaced)
        .when((kind == "email") & (F.length(surrogate) == F.length(entity)), cased)
        .when(kind.isin(*NAMES), named)
        .otherwise(surrogate)
    )


def _pieces(rows: DataFrame) -> DataFrame:
    """One row per part of an entity (a name has several words): rid, at, part, kind, entity, canonical."""
    found = rows.select("__rid", F.posexplode("__entities").alias("at", "found"), "__gaps", "__entities")
    before = F.element_at("__gaps", F.col("at") + 1)
    # a label can be the end of the entity before
    earlier = F.when(F.col("at") > 0, F.element_at("__entities", F.greatest(F.col("at"), F.lit(1)))).otherwise("")
    labelled = F.concat(earlier, before).rlike(f"{LABEL}$")
    found = found.withColumn("kind", _kind(F.col("found"), labelled)).where(F.col("kind").isNotNull())
    title = F.when(before.rlike(rf"(?:{'|'.join(FEMALE)})\.?[ ]$"), "female")
    title = title.when(before.rlike(rf"(?:{'|'.join(NEUTRAL)})\.?[ ]$"), "first").otherwise("male")
    words = F.when(F.col("kind") == "name", F.split("found", " ")).otherwise(F.array("found"))
    found = found.select("__rid", "at", "kind", title.alias("title"), F.size(words).alias("n"), F.posexplode(words).alias("part", "entity"))
    first = (F.col("kind") == "name") & (F.col("part") < F.col("n") - 1)
    kind = (
        F.when(first, F.col("title"))
        .when(F.col("kind") == "name", "last")
        .otherwise(F.col("kind"))
    )
    found = found.withColumn("kind", kind)
    return found.select("__rid", "at", "part", "kind", "entity", _canonical(F.col("kind"), F.col("entity")).alias("canonical"))


def distinct_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, surrogate), one row per distinct entity; no two share a surrogate, none is an entity.

    All parts of names count as one kind here. ``entities`` (kind, canonical) must be landed and distinct. A round
    keeps the draws that are free and draws again for the others, names with one syllable more and addresses with
    a letter more; rounds end when all are free. Where a kind has more entities than surrogates
    of its format this raises.
    """
    settled, attempt = None, 0
    group = F.when(F.col("kind").isin(*NAMES), "name").otherwise(F.col("kind")).alias("group")
    open_ = entities
    while True:
        drawn = open_.withColumn("surrogate", _surrogate(key, F.col("kind"), F.col("canonical"), attempt))
        drawn = drawn.withColumn("rank", F.lit(1))
        both = drawn if settled is None else drawn.unionByName(settled.withColumn("rank", F.lit(0)))
        first = F.row_number().over(Window.partitionBy("group", "surrogate").orderBy("rank", "canonical", "kind")) == 1
        taken = entities.select(group, F.col("canonical").alias("surrogate")).distinct().withColumn("taken", F.lit(True))
        both = both.select("*", group).join(taken, ["group", "surrogate"], "left")
        both = both.withColumn("free", first & F.col("taken").isNull())
        both = landed(both.select("kind", "canonical", "surrogate", "free"), "surrogates")
        settled = both.where("free").drop("free")
        open_ = both.where("not free").select("kind", "canonical")
        if open_.isEmpty():
            return settled
        attempt += 1
        if attempt > MOST_ROUNDS:
            raise ValueError("a kind of entity has more members than its format has surrogates")


def replace_personal_data(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``text`` replaced, and ``n_entities`` (bigint).

    Null texts stay null and empty ones empty, with 0 entities; the text of a row without entities is
    unchanged byte by byte. Repeated rows and null ids are rows like others, as nothing is joined by id. A
    column of ``docs`` called n_entities is replaced. An empty table gives an empty result.
    """
    others = [c for c in docs.columns if c != "n_entities"]
    rows = docs.select(F.struct(*[F.col(c) for c in others]).alias("__row"), F.col(text).alias("__text"))
    has = F.coalesce(F.col("__text").rlike(ANY), F.lit(False))
    hits = rows.where(has).select(
        "__row",
        F.monotonically_increasing_id().alias("__rid"),
        F.split("__text", ANY, -1).alias("__gaps"),
        F.regexp_extract_all("__text", F.lit(ANY), F.lit(0)).alias("__entities"),
    )
    hits = landed(hits, "entities")
    pieces = landed(_pieces(hits), "mentions")
    entities = landed(pieces.select("kind", "canonical").distinct(), "entity-list")
    surrogates = distinct_surrogates(entities, key)

    said = pieces.join(surrogates, ["kind", "canonical"])
    said = said.withColumn("said", _rendered(F.col("kind"), F.col("entity"), F.col("surrogate")))
    said = said.groupBy("__rid").agg(F.sort_array(F.collect_list(F.struct("at", "part", "said"))).alias("__said"))
    joined = hits.join(said, "__rid", "left")
    # a found string that is none (a number that fails its check) has no parts and stays
    new = F.transform(
        "__entities",
        lambda e, i: F.coalesce(
            F.nullif(F.array_join(F.transform(F.filter("__said", lambda s: s["at"] == i), lambda s: s["said"]), " "), F.lit("")), e
        ),
    )
    body = F.concat(
        F.element_at("__gaps", 1),
        F.array_join(F.zip_with(new, F.slice("__gaps", 2, F.greatest(F.size("__entities"), F.lit(1))), lambda e, g: F.concat(e, g)), ""),
    )
    count = F.coalesce(F.size(F.array_distinct(F.transform("__said", lambda s: s["at"]))), F.lit(0))
    changed = joined.select("__row", body.alias("__new"), F.greatest(count, F.lit(0)).cast("bigint").alias("n_entities"))
    same = rows.where(~has).select("__row", F.col("__text").alias("__new"), F.lit(0).cast("bigint").alias("n_entities"))

    def column(c: str) -> Column:
        return (F.col("__new") if c == text else F.col("__row").getField(c)).alias(c)

    return reduce(DataFrame.unionByName, [p.select(*[column(c) for c in others], "n_entities") for p in (same, changed)])

