"""Contract checks as column jobs: validate every record against a contract,
naming every violation; split accepted and quarantined rows; summarise
violations; merge records of several contract versions.

Validation reads the JSON token type of each field (via a variant), so a
number sent for a string field, or text sent for a double, is a violation
even when a lenient cast would succeed.  Rules:

* field absent or JSON null, not nullable and without a default -> ``missing:<f>``
* ``string``: a JSON string only; ``double``/``float``: any JSON number;
  ``long``/``int``: an integer within range; ``boolean``: true/false -> else
  ``type:<f>``
* nullable union: null or absent passes
* extra fields are ignored
* text that is not a JSON object -> the single violation ``malformed``
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.schemas import _PRIMITIVE, Contract

_INTEGER_KINDS = ["BIGINT", "INT", "SMALLINT", "TINYINT"]
_NUMBER_KINDS = _INTEGER_KINDS + ["DOUBLE", "FLOAT"]


def _kind_ok(kind: Column, avro_type: str) -> Column:
    if avro_type == "string":
        return kind == "STRING"
    if avro_type in ("double", "float"):
        return kind.isin(_NUMBER_KINDS) | kind.startswith("DECIMAL")
    if avro_type in ("long", "int"):
        return kind.isin(_INTEGER_KINDS) | kind.rlike(r"^DECIMAL\(\d+,0\)$")
    if avro_type == "boolean":
        return kind == "BOOLEAN"
    if avro_type == "bytes":
        return kind.isin("STRING", "BINARY")
    raise ValueError(avro_type)


def _path(name: str) -> str:
    return "$['" + name.replace("'", "\\'") + "']"


def parsed(value: Column | str) -> Column:
    """The record as a variant; null for text that is not JSON."""
    v = F.col(value) if isinstance(value, str) else value
    return F.try_parse_json(F.decode(v.cast("binary"), "UTF-8"))


def _kinds(record: Column, contract: Contract) -> Column:
    """struct of the JSON token kind of every contract field (null = absent).
    A number that its type can't hold has the kind of no type."""
    def kind(f):
        k = F.schema_of_variant(F.try_variant_get(record, _path(f.name), "variant"))
        if f.value_type in ("long", "int"):
            typed = F.try_variant_get(record, _path(f.name), _PRIMITIVE[f.value_type].simpleString())
            k = F.when(k.isNotNull() & (k != "VOID") & typed.isNull(), F.lit("OUT_OF_RANGE")).otherwise(k)
        return k.alias(f.name)

    return F.struct(*[kind(f) for f in contract.fields])


def _violations_from_kinds(is_object: Column, kinds: Column, contract: Contract) -> Column:
    checks = []
    for f in contract.fields:
        kind = kinds[f.name]
        absent = kind.isNull() | (kind == "VOID")
        checks.append(
            F.when(absent, F.lit(None if f.nullable or f.default_value is not None
                                 else f"missing:{f.name}"))
            .when(~_kind_ok(kind, f.value_type), F.lit(f"type:{f.name}")))
    found = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return F.when(~is_object, F.array(F.lit("malformed"))).otherwise(found)


def _is_object(record: Column) -> Column:
    return F.coalesce(F.schema_of_variant(record).startswith("OBJECT"), F.lit(False))


def violations(record: Column, contract: Contract) -> Column:
    """array<string> of every violation of ``record`` (a variant column)."""
    return _violations_from_kinds(_is_object(record), _kinds(record, contract), contract)


def _once(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns computed exactly once per row.

    The columns come out of a one-row generator; filters on them cannot be
    pushed below it, so the optimizer never copies their (costly) defining
    expressions into later predicates.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def validate(df: DataFrame, value_col: str, contract: Contract) -> DataFrame:
    """Add ``_record`` (variant) and ``violations`` (array<string>).

    The JSON text is parsed once and each field's token kind read once;
    violations are string tests over those kinds.
    """
    staged = _once(df, _record=parsed(value_col))
    staged = _once(staged, _obj=_is_object(F.col("_record")),
                   _kinds=_kinds(F.col("_record"), contract))
    v = _violations_from_kinds(F.col("_obj"), F.col("_kinds"), contract)
    return staged.withColumn("violations", v).drop("_obj", "_kinds")


def typed_fields(record: Column, contract: Contract) -> list[Column]:
    """Contract fields read out of a validated record with their types; an
    absent required field takes its default."""
    def read(f):
        kind = _PRIMITIVE[f.value_type].simpleString()
        c = F.try_variant_get(record, _path(f.name), kind)
        if not f.nullable and f.default_value is not None:
            c = F.coalesce(c, F.lit(f.default_value).cast(kind))
        return c.alias(f.name)

    return [read(f) for f in contract.fields]


def accepted(validated: DataFrame, contract: Contract, keep: Sequence[str] = ()) -> DataFrame:
    """Rows without violations, as typed contract columns."""
    ok = validated.where(F.size("violations") == 0)
    return ok.select(*keep, *typed_fields(F.col("_record"), contract))


def quarantined(validated: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rows with violations; the raw value is kept next to the reasons."""
    return validated.where(F.size("violations") > 0).drop("_record").select(
        *keep, *[c for c in validated.columns if c not in keep and c != "_record"])


def summary(validated: DataFrame) -> DataFrame:
    """(field, kind, n): violation counts, one row per field and kind."""
    v = validated.select(F.explode("violations").alias("v"))
    parts = F.split(F.col("v"), ":", 2)
    return v.select(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")).alias("field"),
                    F.element_at(parts, 1).alias("kind")) \
        .groupBy("field", "kind").agg(F.count(F.lit(1)).alias("n"))


def _conformed(df: DataFrame, f) -> Column:
    t = _PRIMITIVE[f.value_type]
    if f.name in df.columns:
        c = F.col(f.name).cast(t)
        if f.has_default and f.default is not None:
            c = F.coalesce(c, F.lit(f.default).cast(t))
    elif f.has_default:
        c = F.lit(f.default).cast(t)
    else:
        raise ValueError(f"field {f.name!r} is absent and has no default")
    return c.alias(f.name)


def conform(df: DataFrame, target: Contract, keep: Sequence[str] = ()) -> DataFrame:
    """Conform a DataFrame of any contract version to ``target``: fields it
    lacks take the target's default (null where the default is null)."""
    return df.select(*keep, *[_conformed(df, f) for f in target.fields])


def evolve_union(frames: Sequence[DataFrame], target: Contract,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Merge records written with different versions into one table of the
    target version (a union by name; missing fields take defaults)."""
    parts = [conform(df, target, keep) for df in frames]
    return reduce(DataFrame.unionByName, parts)


def _kind_class(kind: Column) -> Column:
    return (F.when(kind.isin(_INTEGER_KINDS), "INTEGER")
            .when(kind.isin("DOUBLE", "FLOAT") | kind.startswith("DECIMAL"), "NUMBER")
            .when(kind == "VOID", "NULL")
            .when(kind.isin("STRING", "BOOLEAN"), kind)
            .otherwise("OTHER"))


# Which observed token classes each contract type reads.
_READS = {
    "string": ["STRING"], "bytes": ["STRING"], "boolean": ["BOOLEAN"],
    "double": ["INTEGER", "NUMBER"], "float": ["INTEGER", "NUMBER"],
    "long": ["INTEGER"], "int": ["INTEGER"],
}


def observed_fields(records: DataFrame, record: str | Column) -> DataFrame:
    """(field, classes, present): every top-level key seen in the records, the
    token classes it took and in how many records it appears; the row without a
    field counts the records.  ``record`` is JSON text or a parsed variant."""
    col = F.col(record) if isinstance(record, str) else record
    text = records.select(col.alias("r")).schema["r"].dataType.simpleString() != "variant"
    rec = records.select((parsed(record) if text else col).alias("r"))
    obj = F.schema_of_variant("r").startswith("OBJECT")
    keys = F.map_entries(F.when(obj, F.try_variant_get("r", "$", "map<string,variant>")))
    seen = F.transform(keys, lambda e: F.struct(e["key"].alias("field"), _kind_class(F.schema_of_variant(e["value"])).alias("class")))
    one = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("class")))
    kv = rec.select(F.inline(F.concat(one, F.coalesce(seen, F.slice(one, 1, 0)))))
    return kv.groupBy("field").agg(F.sort_array(F.collect_set("class")).alias("classes"), F.count(F.lit(1)).alias("present"))


def compat_with_observed(records: DataFrame, record: str | Column,
                         candidates: dict[str, str]) -> DataFrame:
    """Can each candidate contract read every record in the log?

    One row per candidate: (candidate, compatible, problems).  The field
    statistics and the number of records come from one aggregation over all
    records; the candidates' field lists are a few rows of metadata.
    """
    spark = records.sparkSession
    rows = []
    for name, js in candidates.items():
        rows.append((name, None, None, None, None))  # meets the count of records
        for f in Contract.parse(js).fields:
            rows.append((name, f.name, _READS[f.value_type], f.nullable, f.has_default))
    cand = spark.createDataFrame(
        rows, "candidate string, field string, reads array<string>, nullable boolean, "
              "has_default boolean")
    obs = observed_fields(records, record).withColumnRenamed("field", "seen")
    j = cand.join(obs, F.col("field").eqNullSafe(F.col("seen")), "left")
    told = j.groupBy("candidate").agg(
        F.coalesce(F.max(F.when(F.col("field").isNull(), F.col("present"))), F.lit(0)).alias("total"),
        F.collect_list(F.when(F.col("field").isNotNull(), F.struct(
            "field", "reads", "nullable", "has_default", "classes", "present"))).alias("fields"))

    def problem(f: Column) -> Column:
        allowed = F.when(f["nullable"], F.array_union(f["reads"], F.array(F.lit("NULL")))).otherwise(f["reads"])
        needed = ~f["has_default"] & ~f["nullable"]
        return (F.when(f["present"].isNull() & needed, F.concat(F.lit("missing:"), f["field"]))
                .when((F.coalesce(f["present"], F.lit(0)) < F.col("total")) & needed,
                      F.concat(F.lit("sometimes_missing:"), f["field"]))
                .when(F.size(F.array_except(f["classes"], allowed)) > 0, F.concat(F.lit("type:"), f["field"])))

    problems = F.sort_array(F.array_compact(F.transform("fields", problem)))
    return told.select("candidate", problems.alias("problems")).select(
        "candidate", (F.size("problems") == 0).alias("compatible"), "problems")


def route_by_schema_id(framed: DataFrame, registry: DataFrame) -> DataFrame:
    """Attach (subject, version) of each record's schema id; unknown ids keep
    their rows with nulls.  The registry is a catalogue of registered
    versions; AQE broadcasts it where it measures it small."""
    reg = registry.select("schema_id", "subject", "version")
    return framed.join(reg, "schema_id", "left")
