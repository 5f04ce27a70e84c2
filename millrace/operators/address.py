"""Resolution of free-text addresses against a dictionary of known places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.addresses import building_dong, building_ho, token_count, token_prefix
from millrace.operators.numbering import range_row_number
from millrace.operators.skew import hot_hashes, join_unique, sized
from millrace.schemas import ADDRESS_DICTIONARY, ADDRESS_MASTER
from millrace.session import land


def unresolved_keys(
    owner: DataFrame, column: str, known: DataFrame, known_column: str, skip_blank: bool = True
) -> DataFrame:
    """Distinct values of ``column`` that are not yet in ``known``; nulls (and blanks) are left out."""
    values = owner.select(column).where(F.col(column).isNotNull())
    if skip_blank and dict(owner.dtypes)[column] == "string":
        values = values.where(F.col(column) != "")
    seen = known.select(F.col(known_column).alias(column)).distinct()
    # both sides are distinct, so no key is hot here
    return values.distinct().join(sized(seen, known.count()), column, "left_anti")


# bits of the largest filter of prefixes, 8 MB; and bits for each entry of a small one
MOST_BITS = 1 << 26
ENTRY_BITS = 64
_BITMAP = 1 << 15


def _filter_place(text: Column, bits: int) -> tuple[Column, Column]:
    """Which bitmap of a filter of ``bits`` bits a text falls into, and the bit there."""
    place = F.pmod(F.xxhash64(text, F.lit(5)), F.lit(bits))
    return F.floor(place / F.lit(_BITMAP)).cast("int"), (place % _BITMAP).cast("int")


def prefix_filter(keywords: DataFrame, column: str, bits: int) -> DataFrame:
    """A Bloom filter of the values of ``column``: rows (bitmap_no, bitmap), at most bits / 32,768 of 4 KB."""
    number, bit = _filter_place(F.col(column), bits)
    placed = keywords.select(number.alias("bitmap_no"), bit.cast("bigint").alias("bit"))
    return placed.groupBy("bitmap_no").agg(F.call_function("bitmap_construct_agg", F.col("bit")).alias("bitmap"))


def prefix_candidates(texts: DataFrame, column: str, out: str, most: int, held: DataFrame, bits: int) -> DataFrame:
    """Rows (text, n_tokens, prefix) of the leading tokens of each text, up to ``most``, that the filter lets pass.

    The filter is broadcast, so what it stops is never shuffled. It stops no prefix that an entry has.
    """
    sizes = F.sequence(F.lit(1), F.least(token_count(F.col(column)), F.lit(most)))
    spread = texts.select(column, F.explode(sizes).alias("n_tokens"))
    spread = spread.withColumn(out, token_prefix(F.col(column), F.col("n_tokens")))
    number, bit = _filter_place(F.col(out), bits)
    spread = spread.withColumns({"bitmap_no": number, "__bit": bit}).join(F.broadcast(held), "bitmap_no")
    octet = F.conv(F.hex(F.substring("bitmap", F.floor(F.col("__bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    power = F.get(F.array(*[F.lit(1 << k) for k in range(8)]), F.col("__bit") % 8)
    return spread.where(octet.bitwiseAND(power) > 0).select(column, "n_tokens", out)


def longest_prefix(keys: DataFrame, column: str, dictionary: DataFrame, keyword_column: str) -> DataFrame:
    """Match every text with the dictionary entry that equals its longest run of leading tokens.

    Adds the keyword column, n_tokens and the dictionary's other columns; texts without a match have nulls.
    Distinct texts are expanded to their prefixes, as long as the longest entry at most; a filter of the entries, of
    bounded size and broadcast, drops nearly all that have none before anything is shuffled, and none that has one.
    Of several entries for one keyword the greatest is used.
    """
    payload = [c for c in dictionary.columns if c != keyword_column]
    entries = dictionary.where(F.col(keyword_column).isNotNull())
    if payload:
        entries = entries.groupBy(keyword_column).agg(F.max(F.struct(*payload)).alias("__entry"))
    else:
        entries = entries.select(keyword_column).distinct().withColumn("__entry", F.struct(F.lit(True)))
    entries = land(entries, "entries")
    size = entries.agg(
        F.count("*").alias("n"), F.coalesce(F.max(token_count(F.col(keyword_column))), F.lit(1)).alias("most")
    ).first()
    bits = min(MOST_BITS, max(_BITMAP, 1 << (ENTRY_BITS * size.n).bit_length()))
    held = land(prefix_filter(entries, keyword_column, bits), "prefix-filter")

    def candidates(texts: DataFrame) -> DataFrame:
        return prefix_candidates(texts, column, keyword_column, size.most, held, bits)

    present = land(keys.select(column).where(F.col(column).isNotNull()).distinct(), "texts")
    # a short prefix may begin a third of all texts
    hot = hot_hashes(present, [keyword_column], expand=candidates)
    hits = join_unique(candidates(present), entries, keyword_column, "inner", hot, unique=True, most=size.n)
    best = hits.groupBy(column).agg(
        F.max_by(F.struct(keyword_column, "n_tokens", "__entry"), "n_tokens").alias("__best")
    )
    matched = join_unique(keys, best, column, "left", unique=True, most=present.count())
    return matched.select(
        *keys.columns,
        F.col(f"__best.{keyword_column}").alias(keyword_column),
        F.col("__best.n_tokens").cast("bigint").alias("n_tokens"),
        *[F.col(f"__best.__entry.{c}").alias(c) for c in payload],
    )


def geocoder_answers(answers: DataFrame) -> DataFrame:
    """Landed answers (keyword, answer) as a dictionary: keyword, total_count, road_address, address, is_error.

    The first place found counts. An answer with the key ``errorType``, whatever its value, and one that is no JSON or
    tells no count, is an error. Of several answers for one keyword one without an error wins.
    """
    place = ADDRESS_DICTIONARY
    form = T.StructType([T.StructField(n, place[n].dataType) for n in ("road_address", "address")])
    shape = T.StructType(
        [
            T.StructField("meta", T.StructType([T.StructField("total_count", T.IntegerType())])),
            T.StructField("documents", T.ArrayType(form)),
        ]
    )
    keys = F.from_json("answer", "map<string,string>")
    read = answers.where(F.col("keyword").isNotNull()).select("keyword", keys.alias("keys"), F.from_json("answer", shape).alias("body"))
    failed = F.coalesce(F.map_contains_key("keys", "errorType"), F.lit(True)) | F.col("body.meta.total_count").isNull()
    first = F.get("body.documents", F.lit(0))
    told = read.select(
        "keyword",
        F.struct(
            (~failed).alias("good"),
            F.when(~failed, F.col("body.meta.total_count")).alias("total_count"),
            first["road_address"].alias("road_address"),
            first["address"].alias("address"),
        ).alias("told"),
    )
    best = told.groupBy("keyword").agg(F.max("told").alias("told"))
    return best.select(
        "keyword", "told.total_count", "told.road_address", "told.address", (~F.col("told.good")).alias("is_error")
    )


def unit_extract(df: DataFrame, address_column: str, building_column: str | None = None) -> DataFrame:
    """Add building_dong and building_ho, read from the address text.

    With ``building_column`` both stay null where there is no building name.
    """
    address = F.col(address_column)
    dong, ho = building_dong(address), building_ho(address)
    if building_column is not None:
        named = F.coalesce(F.col(building_column), F.lit("")) != ""
        dong, ho = F.when(named, dong), F.when(named, ho)
    return df.withColumns({"building_dong": dong, "building_ho": ho})


def resolve_address(
    matched: DataFrame, address_column: str = "legacy_address", keep: Sequence[str] = ()
) -> DataFrame:
    """Address records of matched texts: the road form where there is one, else the lot form.

    Needs total_count and the structs road_address and address. Building, unit and zone come from the road
    form only, region_3depth_h_name from the lot form only; empty strings become null.
    """

    def text(form: str, field: str):
        return F.nullif(F.col(f"{form}.{field}"), F.lit(""))

    def either(field: str):
        return F.when(road, text("road_address", field)).when(lot, text("address", field)).alias(field)

    road, lot = F.col("road_address").isNotNull(), F.col("address").isNotNull()
    building = F.when(road, text("road_address", "building_name"))
    records = matched.select(
        *keep,
        F.col(address_column).alias("legacy_address"),
        F.col("total_count").cast("int").alias("accuracy"),
        road.alias("road_address_tf"),
        either("address_name"),
        either("region_1depth_name"),
        either("region_2depth_name"),
        either("region_3depth_name"),
        F.when(~road & lot, text("address", "region_3depth_h_name")).alias("region_3depth_h_name"),
        building.alias("building_name"),
        F.when(road, text("road_address", "zone_no")).alias("zone_no"),
        either("x"),
        either("y"),
    )
    return unit_extract(records, "legacy_address", "building_name")


def negative_markers(
    resolved: DataFrame, key_column: str, hit_column: str, keep: Sequence[str] = ()
) -> DataFrame:
    """The keys that found nothing, to be stored so that they are not looked up again."""
    return resolved.where(F.col(hit_column).isNull()).select(key_column, *keep)


def resolve_new_addresses(
    owners: Sequence[tuple[DataFrame, str]],
    address_master: DataFrame,
    dictionary: DataFrame,
    register_dt,
    skip_blank: bool = True,
    given: DataFrame | None = None,
) -> DataFrame:
    """New rows for the address table from all owner tables at once, hits and negative markers.

    ``dictionary`` has keyword, total_count, road_address and address. Where it has ``is_error`` too
    (``geocoder_answers``), an address whose longest answered prefix is an error stays open: it gets no row and no number,
    and the next run asks again. New rows are numbered on from the highest ``seq``. ``given`` (legacy_address, seq) are numbers that an earlier run of the same step gave:
    its addresses keep them.
    """
    texts = None
    for owner, column in owners:
        part = owner.select(F.col(column).alias("legacy_address"))
        texts = part if texts is None else texts.unionByName(part)
    new = unresolved_keys(texts, "legacy_address", address_master, "legacy_address", skip_blank)
    taken = address_master.select("seq")
    if given is None:
        both = new.withColumn("seq", F.lit(None).cast("bigint"))
    else:
        taken = taken.unionByName(given.select("seq"))
        numbers = given.groupBy("legacy_address").agg(F.min("seq").alias("seq"))
        both = new.join(sized(numbers, given.count()), "legacy_address", "left")
    if "is_error" in dictionary.columns:
        entries = dictionary.where("total_count > 0 OR is_error")
    else:
        entries = dictionary.where("total_count > 0").withColumn("is_error", F.lit(False))
    found = longest_prefix(land(both, "addresses"), "legacy_address", entries, "keyword")
    found = land(found.where(~F.coalesce("is_error", F.lit(False))).drop("is_error"), "found")
    top = taken.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("top")).first().top
    fresh = land(found.where("seq IS NULL").drop("seq"), "fresh")
    numbered = range_row_number(fresh, ["legacy_address"], out="seq").withColumn("seq", F.col("seq") + top)
    found = numbered.unionByName(found.where("seq IS NOT NULL"))
    hits = resolve_address(found.where(F.col("keyword").isNotNull()), keep=["seq"])
    markers = negative_markers(found, "legacy_address", "keyword", keep=["seq"])
    rows = hits.unionByName(markers, allowMissingColumns=True)
    return rows.withColumn("register_dt", F.lit(register_dt).cast("timestamp_ntz")).select(
        *ADDRESS_MASTER.fieldNames()
    )


def retry_markers(address_master: DataFrame, dictionary: DataFrame, register_dt) -> DataFrame:
    """Rows of the address table that had no hit before and have one now, with their old number.

    Columns of ``address_master`` beyond the fixed ones are kept.
    """
    extra = [c for c in address_master.columns if c not in ADDRESS_MASTER.fieldNames()]
    markers = address_master.where(F.col("accuracy").isNull()).select("legacy_address", "seq", *extra)
    if "is_error" in dictionary.columns:
        dictionary = dictionary.where("total_count > 0 OR is_error")
    found = longest_prefix(markers, "legacy_address", dictionary, "keyword").where("total_count > 0")
    hits = resolve_address(found.where(F.col("keyword").isNotNull()), keep=["seq", *extra])
    return hits.withColumn("register_dt", F.lit(register_dt).cast("timestamp_ntz")).select(
        *address_master.columns
    )


def mark_surrogate(
    df: DataFrame, on: str, reference: DataFrame, reference_on: str, seq_column: str, out: str = "addr_seq"
) -> DataFrame:
    """Put the reference row's number on every row by its key; null where there is none."""
    numbers = reference.groupBy(F.col(reference_on).alias(on)).agg(F.max(seq_column).alias(out))
    return join_unique(df, numbers, on, "left", unique=True, most=reference.count()).select(*df.columns, out)
