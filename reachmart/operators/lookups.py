"""Finding records: by id or e-mail, by search term, one per id."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reachmart.operators.key_join import join_keys, key_set

DISPLAY_COLUMNS = ["customer_id", "email", "first_name", "segment", "score", "source", "salesforce_status"]


def find_entries(entries: DataFrame, key: str) -> DataFrame:
    """All entries with this id; if there are none, all with this e-mail in any case."""
    by_id = entries.filter(F.col("customer_id").cast("string") == key)
    by_email = entries.filter(F.lower("email") == key.lower())
    return by_id.unionByName(by_email.filter(~by_id.select(F.lit(1)).exists()))


def find_all(entries: DataFrame, keys: DataFrame, key: str = "lookup") -> DataFrame:
    """The same for a column of lookup keys; adds the key and how it was found."""
    wanted = key_set(keys, F.col(key))
    by_id = join_keys(entries, F.col("customer_id"), wanted, "inner").withColumnRenamed("key", "lookup")
    others = wanted.join(key_set(entries, F.col("customer_id")), "key", "left_anti")
    emails = others.select(F.lower("key").alias("key"), F.col("key").alias("lookup"))
    by_email = join_keys(entries, F.lower("email"), emails, "inner").drop("key")
    return by_id.withColumn("found_by", F.lit("id")).unionByName(by_email.withColumn("found_by", F.lit("email")))


def search(records: DataFrame, term: str, regex: bool = False) -> DataFrame:
    """Records whose e-mail or first name contains the term in any case; a missing value
    does not match. ``regex`` reads the term as a pattern."""

    def hit(name: str):
        text = F.col(name).cast("string")
        found = text.rlike(f"(?i){term}") if regex else F.contains(F.lower(text), F.lit(term.lower()))
        return F.coalesce(found, F.lit(False))

    match = hit("email")
    if "first_name" in records.columns:
        match = match | hit("first_name")
    return records.filter(match)


def shown(records: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The display columns that exist."""
    return records.select(*[name for name in columns or DISPLAY_COLUMNS if name in records.columns])


def first_of(records: DataFrame, customer_id: str, order_by: list[str]) -> DataFrame:
    """The first record of one id: a top-1 over the rows of that id, without a window."""
    chosen = records.filter(F.col("customer_id").cast("string") == customer_id)
    return chosen.orderBy(*order_by).limit(1)


def first_per_id(records: DataFrame, order_by: list[str]) -> DataFrame:
    """The first record of every id; all other columns break ties. An aggregate with a
    map-side part, not a window: the rows of a hot id never meet in one task."""
    names = records.columns
    whole = F.struct(*order_by, *[name for name in names if name not in order_by])
    known = records.filter(F.col("customer_id").isNotNull())
    firsts = known.groupBy("customer_id").agg(F.min(whole).alias("_row"))
    return firsts.select(*[F.col("_row")[name].alias(name) for name in names])
