"""Catalogue-like data made from the given tables.

The tables hold no cards, so rows of ``part`` get names, codes, labels and texts by rules on their
key.  The rules are plain SQL that Spark and the checking engine both run; their size is that of
the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.functions.urls import ImagePolicy

POLICY = ImagePolicy("cdn.example.net", "https://example.org/coming-soon.jpg")

_LETTER = "substr('RCHLS', CAST({k} % 5 AS INT) + 1, 1)"


def _code(k: str) -> str:
    return (
        f"CAST(1 + {k} % 27 AS STRING) || '-' || lpad(CAST({k} % 997 AS STRING), 3, '0') || "
        + _LETTER.format(k=k)
    )


def _pick(k: str, n: int, options: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(options[:-1]))
    return f"CASE {k} % {n} {whens} ELSE {options[-1]} END"


K = "p_partkey"

CATALOGUE_FIELDS = {
    "product_id": K,
    "group_id": f"{K} % 25",
    "raw_name": _pick(
        K,
        12,
        [
            "p_name",
            f"p_name || ' - ' || {_code(K)}",
            "p_name || ' - PR-055/7-001H (Full Art)'",
            "p_name || ' (Common)'",
            "p_name || ' (1'",
            "p_name || ' (19 (Full Art)'",
            "p_name || ' (April 2024)'",
            "p_name || ' EX (B-038)'",
            f"p_name || ' - PR-' || CAST({K} % 200 AS STRING)",
            "p_name || ' (Class Zero Cadet) (Rare)'",
            "p_name || ' – C-004 (Worlds 2019)'",
            "p_name || ' LB (Foo) tail'",
        ],
    ),
    "number_text": _pick(
        K,
        9,
        [
            _code(K),
            f"'PR-' || CAST({K} % 200 AS STRING) || '/' || {_code(K)}",
            f"'Re-' || CAST({K} % 300 AS STRING) || 'C;' || {_code(K)}",
            f"'C-' || CAST({K} % 100 AS STRING)",
            f"'B-' || lpad(CAST({K} % 100 AS STRING), 3, '0')",
            f"'A' || CAST({K} % 100 AS STRING)",
            "NULL",
            f"'0-' || {_code(K)} || ', x ,' || {_code(K)}",
            f"lower(replace({_code(K)}, '-', '.'))",
        ],
    ),
    "card_type": _pick(K, 7, ["'Forward'", "'Summon'", "'crystal'", "'Sealed Product'", "NULL", "p_type"]),
    "element": _pick(K, 6, ["'fire'", "'WATER;ice'", "'wind, earth'", "''", "NULL", "' Lightning ; '"]),
    "category": _pick(
        K,
        8,
        [
            "'VII'",
            "'VII;DFF'",
            "'DFF&middot;' || p_type",
            "p_type || '; xiv'",
            "'MOBIUS'",
            "NULL",
            "'World of Final Fantasy·MIX'",
            "p_type || '·' || p_type",
        ],
    ),
    "cost_text": _pick(K, 5, ["CAST(p_size AS STRING)", "CAST(p_size AS STRING) || ' cp'", "''", "NULL", "'X'"]),
    "power_text": _pick(K, 3, ["CAST(p_size * 1000 AS STRING)", "'none'", "NULL"]),
    "job": _pick(K, 4, ["'Knight'", "'Mage'", "NULL", "''"]),
    "rarity": "substr('CRHLSZ', CAST(p_partkey % 6 AS INT) + 1, 1)",
    "description": _pick(
        K,
        7,
        [
            "'Dull: Choose ' || p_name",
            "'[Dull] Other Dull: ' || p_name || ' Dull Dull [Dull]'",
            "'ex burst ' || p_name",
            "'<b>Dull</b>: x [Dull]'",
            "NULL",
            "p_name || ' : a : b'",
            "'《火》《3》[[i]]' || p_name || '[[/]] : put 《光》'",
        ],
    ),
    "image_url": _pick(
        K,
        5,
        [
            f"'https://img.example.com/p_' || CAST({K} AS STRING) || '_200w.jpg'",
            f"'https://cdn.example.net/cards/full/' || CAST({K} AS STRING) || '_eg.jpg'",
            f"'https://cdn.example.net/cards/thumbs/' || CAST({K} AS STRING) || '_eg.jpg'",
            "'https://img.example.com/image-missing.svg'",
            "NULL",
        ],
    ),
    "set_name": f"CASE WHEN {K} % 13 = 0 THEN NULL ELSE 'NATION_' || CAST({K} % 25 AS STRING) END",
}

SOURCE_FIELDS = {
    "row_id": K,
    "code": _pick(
        K,
        4,
        [
            _code(K),
            f"'PR-' || lpad(CAST({K} % 200 AS STRING), 3, '0')",
            f"{_code(K)} || '/' || {_code('(p_partkey + 7)')}",
            f"'C-' || lpad(CAST({K} % 100 AS STRING), 3, '0')",
        ],
    ),
    "name": "p_brand || ' ' || p_name",
    "type": _pick(K, 5, ["'Forward'", "'Summon'", "'Crystal'", "''", "p_type"]),
    "job": _pick(K, 3, ["'Knight'", "'Thief'", "''"]),
    "text": _pick(K, 4, ["'[[i]]New[[/]] ' || p_name || ': Dull Dull'", "''", "'《水》 ' || p_name", "'   '"]),
    "element": _pick(K, 3, ["'火'", "'水'", "'Fire'"]),
    "rarity": "substr('SCRHL', CAST(p_partkey % 5 AS INT) + 1, 1)",
    "cost": "CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(p_size AS BIGINT) END",
    "power": "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_size * 1000 AS BIGINT) END",
    "category_1": _pick(K, 4, ["'VII'", "'xiv'", "p_type", "''"]),
    "category_2": _pick(K, 3, ["NULL", "'DFF'", "'VII'"]),
    "multicard": "CAST(p_partkey % 2 AS STRING)",
    "ex_burst": "CAST(p_partkey % 3 AS STRING)",
    "set_name": f"CASE WHEN {K} % 11 = 0 THEN NULL ELSE ' nation_' || CAST({K} % 25 AS STRING) || ' ' END",
}


def _select(fields: dict[str, str], table: str) -> str:
    return "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in fields.items()) + f" FROM {table}"


CATALOGUE_SQL = _select(CATALOGUE_FIELDS, "part")
SOURCE_SQL = _select(SOURCE_FIELDS, "part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks_for(rows: DataFrame, per_task: int) -> int:
    """How many tasks of about ``per_task`` rows a table makes; the count comes from the files' footers."""
    return max(1, -(-rows.count() // per_task))


def spread(rows: DataFrame, per_task: int = 25_000) -> DataFrame:
    """The rows in tasks of about ``per_task``: where columns pack well a file is few bytes, and a task would get millions."""
    n = tasks_for(rows, per_task)
    return rows.repartition(n) if n > 1 else rows


def _run(spark: SparkSession, sf_dir: str, fields: dict[str, str]) -> DataFrame:
    return spread(table(spark, sf_dir, "part")).selectExpr(*[f"{sql} AS {name}" for name, sql in fields.items()])


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw marketplace rows with plain columns."""
    return _run(spark, sf_dir, CATALOGUE_FIELDS)


def products(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """The same rows in the shape of the product feed, with some plain columns kept on request."""
    names = {
        "Number": "number_text",
        "CardType": "card_type",
        "Element": "element",
        "Category": "category",
        "Cost": "cost_text",
        "Power": "power_text",
        "Job": "job",
        "Rarity": "rarity",
        "Description": "description",
    }
    attrs = F.array(
        *[
            F.struct(F.lit(n).alias("name"), F.lit(n).alias("display_name"), F.col(c).alias("value"))
            for n, c in names.items()
        ]
    )
    rows = catalogue(spark, sf_dir)
    return rows.select(
        "product_id",
        F.col("raw_name").alias("name"),
        F.col("raw_name").alias("clean_name"),
        "image_url",
        "group_id",
        F.lit("2024-01-01").alias("modified_on"),
        F.filter(attrs, lambda a: a["value"].isNotNull()).alias("extended_data"),
        *keep,
    )


def source_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second-source rows as stored."""
    rows = _run(spark, sf_dir, SOURCE_FIELDS)
    sets = F.when(F.col("set_name").isNotNull(), F.array("set_name"))
    doc = F.concat(
        F.replace(F.col("code"), F.lit("/"), F.lit(";")), F.lit("_"), F.lpad(F.col("row_id").cast("string"), 12, "0")
    )
    none = F.array().cast("array<string>")
    return rows.select(
        doc.alias("doc_id"), "code", "name", "type", "job", "text", F.array("element").alias("element"), "rarity",
        "cost", "power", "category_1", "category_2", "multicard", "ex_burst", sets.alias("set"),
        F.struct(none.alias("thumbs"), none.alias("full")).alias("images"), "row_id",
    )


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One group per nation; every fifth is supplemental, publishing times go backwards."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("group_id"),
        F.when(F.col("n_nationkey") % 5 == 0, F.concat("n_name", F.lit(" Deck"))).otherwise(F.col("n_name")).alias("name"),
        F.timestamp_seconds(F.lit(1_700_000_000) - F.col("n_nationkey").cast("bigint") * 86400).alias("published_on"),
    )


def land_feeds(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Groups, products and second-source rows as JSON lines in the feeds' own field names."""
    g = groups(spark, sf_dir)
    g.select(
        F.col("group_id").alias("groupId"), "name", F.col("name").alias("abbreviation"),
        F.date_format("published_on", "yyyy-MM-dd'T'HH:mm:ss").alias("publishedOn"), F.lit("2024-01-01").alias("modifiedOn"),
    ).write.json(f"{folder}/groups")
    p = products(spark, sf_dir)
    attrs = F.transform(
        "extended_data",
        lambda a: F.named_struct(
            F.lit("name"), a["name"], F.lit("displayName"), a["display_name"], F.lit("value"), a["value"]
        ),
    )
    p.select(
        F.col("product_id").alias("productId"), "name", F.col("clean_name").alias("cleanName"),
        F.col("image_url").alias("imageUrl"), F.col("group_id").alias("groupId"),
        F.col("modified_on").alias("modifiedOn"), attrs.alias("extendedData"),
    ).write.json(f"{folder}/products")
    s = source_cards(spark, sf_dir)
    s.select(
        F.col("row_id").cast("string").alias("id"), "code", F.col("name").alias("name_en"), F.col("type").alias("type_en"),
        F.col("job").alias("job_en"), F.col("text").alias("text_en"), "element", "rarity", F.col("cost").cast("string").alias("cost"),
        F.col("power").cast("string").alias("power"), "category_1", "category_2", "multicard", "ex_burst",
        # the set name tells rows of one code apart, so every row has a key of its own
        F.coalesce("set", F.array(F.concat(F.lit("row "), F.col("row_id").cast("string")))).alias("set"), "images",
    ).write.json(f"{folder}/source")
