"""Change capture: envelopes, row images, versions, anonymization and collapse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.binary import U64, to_u64
from ..functions.binding import with_once
from ..schema import cdc_envelope
from ..sources.rules import RULES, RuleSet
from .records import OPERATIONS, lookup

TABLE_PREFIX = "cdc.public."


def parse_cdc(df: DataFrame, image: T.StructType) -> DataFrame:
    """Add the parsed envelope ``e`` and ``kind``: record, tombstone (null value) or error (bad JSON)."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = with_once(df, "e", F.from_json("value", cdc_envelope(image), options))
    kind = (
        F.when(F.col("value").isNull(), "tombstone")
        .when(F.col("e._corrupt").isNotNull() | F.col("e").isNull(), "error")
        .otherwise("record")
    )
    return parsed.withColumn("kind", kind)


def cdc_op_label(op: Column) -> Column:
    return lookup(op, OPERATIONS, F.concat(F.lit("op="), F.coalesce(op, F.lit(""))))


def table_from_topic(topic: Column, prefix: str = TABLE_PREFIX) -> Column:
    """Table name behind the prefix; other topics give the empty text."""
    return F.when(topic.startswith(prefix), F.substring(topic, len(prefix) + 1, 1 << 20)).otherwise("")


def cdc_version(source: Column) -> Column:
    """``lsn`` as number or numeric text, else the source time, else 0; unsigned, exact up to 2**64 - 1.

    A larger number does not fit and reads as missing, see :func:`version_error`.
    """
    small = F.try_to_number(source["lsn"], F.lit("9999999999999999999")).cast(U64)
    return F.coalesce(to_u64(source["lsn"]), small, source["ts_ms"].try_cast("bigint").cast(U64), F.lit(0).cast(U64))


def version_error(source: Column) -> Column:
    """True when an ``lsn`` is a number that does not fit into 64 bits."""
    return source["lsn"].rlike("^[0-9]+$") & to_u64(source["lsn"]).isNull()


def cdc_row_image(parsed: DataFrame) -> DataFrame:
    """Rows to keep: ``after`` of c, u and r, ``before`` with ``_deleted`` = 1 of d; everything else drops out."""
    op = F.col("e.op")
    image = F.when(op == "d", F.col("e.before")).when(op.isin("c", "u", "r"), F.col("e.after"))
    return (
        parsed.filter("kind = 'record'")
        .withColumn("image", image)
        .filter("image IS NOT NULL")
        .withColumn("_deleted", (op == "d").cast("int"))
        .withColumn("cdc_lsn", cdc_version(F.col("e.source")))
    )


def cdc_changed_fields(parsed: DataFrame, image: T.StructType) -> DataFrame:
    """One row per field that an update changed, with both values as text."""
    pairs = [
        F.struct(
            F.lit(f.name).alias("field"),
            F.col(f"e.before.{f.name}").cast("string").alias("before"),
            F.col(f"e.after.{f.name}").cast("string").alias("after"),
        )
        for f in image.fields
    ]
    changed = F.filter(F.array(*pairs), lambda p: ~p["before"].eqNullSafe(p["after"]))
    updates = parsed.filter("kind = 'record' AND e.op = 'u' AND e.before IS NOT NULL AND e.after IS NOT NULL")
    keep = [c for c in parsed.columns if c not in ("e", "value", "kind")]
    return updates.select(*keep, F.inline(changed))


def anonymize(images: DataFrame, rules: RuleSet, table: str, image: T.StructType) -> DataFrame:
    """Apply the rules of one table as a single projection and add target topic, version and delete flag.

    Fields without a rule pass through; the rules are resolved when the plan is
    built, so dropped fields are never read from the parsed value.
    """
    if table not in rules.tables:
        return images.limit(0)
    spec = rules.tables[table]
    columns = []
    for f in image.fields:
        name = spec.fields.get(f.name, "passthrough")
        build = RULES[name]
        if build is None:
            continue
        value = F.col(f"image.{f.name}")
        columns.append((value if name == "passthrough" else build(value, rules.salt)).alias(f.name))
    coords = [c for c in ("topic", "partition", "offset", "key") if c in images.columns]
    mine = images.filter(table_from_topic(F.col("topic")) == table)
    return mine.select(*coords, F.lit(spec.target_topic).alias("target_topic"), *columns, "cdc_lsn", "_deleted")


def union_image(images: dict[str, T.StructType]) -> T.StructType:
    """All fields of the row images of several tables, so that one parse serves them; a shared name has one type."""
    fields: dict[str, T.StructField] = {}
    for table, image in images.items():
        for f in image.fields:
            if fields.setdefault(f.name, f).dataType != f.dataType:
                raise ValueError(f"field {f.name} of {table} has another type elsewhere")
    return T.StructType(list(fields.values()))


def _rule_of(rules: RuleSet, table: str, name: str) -> str:
    return rules.tables[table].fields.get(name, "passthrough")


def kept_fields(rules: RuleSet, table: str, image: T.StructType) -> list[str]:
    """Fields of a table that its rules don't drop."""
    return [f.name for f in image.fields if RULES[_rule_of(rules, table, f.name)] is not None]


def anonymize_tables(changes: DataFrame, rules: RuleSet, images: dict[str, T.StructType]) -> DataFrame:
    """Change rows of all tables, parsed once and anonymized by the rules of their own table, in one projection.

    Rows are ``topic, partition, offset, key, outcome, target_topic, cause, raw``, the fields that a table keeps, and
    ``cdc_lsn, _deleted``. ``outcome`` is row, or malformed with its cause and text; a malformed row of a table without
    rules has the target none. A field that no table keeps is no column; one that a table drops or lacks is null in
    its rows. Tombstones, other operations and tables without rules drop out, as with one table.
    """
    known = [t for t in images if t in rules.tables]
    parsed = split_malformed(parse_cdc(changes, union_image({t: images[t] for t in known})))
    op, table = F.col("e.op"), table_from_topic(F.col("topic"))
    image = F.when(op == "d", F.col("e.before")).when(op.isin("c", "u", "r"), F.col("e.after"))
    good = (F.col("kind") == "record") & image.isNotNull() & table.isin(known)
    rows = parsed.withColumns({"image": image, "__table": table}).filter(good | F.col("cause").isNotNull())
    good = F.col("cause").isNull()
    columns = []
    for f in union_image({t: images[t] for t in known}).fields:
        by_rule: dict[str, list[str]] = {}
        for t in known:
            if f.name in kept_fields(rules, t, images[t]):
                by_rule.setdefault(_rule_of(rules, t, f.name), []).append(t)
        if not by_rule:
            continue
        value, column = F.col(f"image.{f.name}"), None
        for name, tables in by_rule.items():
            built = value if name == "passthrough" else RULES[name](value, rules.salt)
            mine = good & F.col("__table").isin(tables)
            column = F.when(mine, built) if column is None else column.when(mine, built)
        columns.append(column.alias(f.name))
    target = lookup(F.col("__table"), {t: s.target_topic for t, s in rules.tables.items()}, F.lit("none"))
    return rows.select(
        "topic", "partition", "offset", "key", F.when(good, "row").otherwise("malformed").alias("outcome"),
        target.alias("target_topic"), "cause", F.when(~good, F.col("value")).alias("raw"), *columns,
        F.when(good, cdc_version(F.col("e.source"))).alias("cdc_lsn"),
        F.when(good, (op == "d").cast("int")).alias("_deleted"),
    )


def replacing_final(df: DataFrame, key: str, version: str, arrival: str = "offset", drop_deleted: bool = False) -> DataFrame:
    """Highest version per key, equal versions by later arrival; an aggregate, not a sorted window."""
    rest = [c for c in df.columns if c != key]
    last = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(version, arrival)).alias("r")).select(key, "r.*")
    return last.filter("_deleted = 0").select(*df.columns) if drop_deleted else last.select(*df.columns)


def split_malformed(parsed: DataFrame, tolerance: str = "all") -> DataFrame:
    """Add ``cause`` to rows that do not parse; tolerance ``none`` fails the job on the first one.

    Filter on ``cause`` for the good rows and the dead letters.
    """
    if tolerance not in ("all", "none"):
        raise ValueError(f"unknown tolerance {tolerance!r}")
    cause = F.when(F.col("kind") == "error", F.concat(F.lit("malformed record of "), F.octet_length("value"), F.lit(" bytes")))
    if tolerance == "none":
        cause = F.when(F.col("kind") == "error", F.raise_error(F.concat(F.lit("malformed record at offset "), "offset")))
    return parsed.withColumn("cause", cause.cast("string"))


def unwrap(df: DataFrame) -> DataFrame:
    """Envelope to the new row text; a delete and a tombstone become a null value."""
    return df.withColumn("value", F.get_json_object("value", "$.after"))


def extract_key(field: str):
    """Transform that replaces a JSON key by one of its fields."""
    return lambda df: df.withColumn("key", F.get_json_object("key", f"$.{field}"))


def route_index(pattern: str, replacement: str):
    """Transform that derives the target from the topic by a regular expression."""
    return lambda df: df.withColumn("index", F.regexp_replace("topic", pattern, replacement))


# Single-record transforms usable by name, in the order a pipeline lists them.
TRANSFORMS = {
    "unwrap": lambda: unwrap,
    "extract_key": extract_key,
    "route_index": route_index,
}
SEARCH_CHAIN = [("unwrap",), ("extract_key", "id"), ("route_index", r"search\.public\.(.*)", "$1_v1")]


def transforms_by_name(steps: list[tuple]) -> list:
    unknown = [s[0] for s in steps if s[0] not in TRANSFORMS]
    if unknown:
        raise ValueError(f"unknown transforms {unknown}")
    return [TRANSFORMS[name](*args) for name, *args in steps]


def search_flatten(df: DataFrame) -> DataFrame:
    """Change rows of the search feed to documents: id, target index and document text or null."""
    for fn in transforms_by_name(SEARCH_CHAIN):
        df = df.transform(fn)
    return df
