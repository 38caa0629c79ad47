"""Versioned event contracts on JSON text: validation, upgrade, dead letters, compatibility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The two versions of the user event. Patterns and formats are part of the
# documents but take no part in validation.
_BASE = {
    "event_id": {"type": "string", "pattern": "^evt_[a-z0-9]+$"},
    "user_id": {"type": "integer", "minimum": 1},
    "event_type": {"type": "string", "enum": ["signup", "login", "purchase", "logout"]},
    "timestamp": {"type": "string", "format": "date-time"},
    "metadata": {"type": "object"},
}
USER_EVENT = {
    "v1": {"required": ["event_id", "user_id", "event_type", "timestamp"], "properties": _BASE},
    "v2": {
        "required": ["event_id", "user_id", "event_type", "timestamp", "source"],
        "properties": {
            **_BASE,
            "event_type": {"type": "string", "enum": ["signup", "login", "purchase", "logout", "view"]},
            "source": {"type": "string", "enum": ["web", "mobile", "api"]},
        },
    },
}

# JSON kinds by the first letters of their variant schema, as the messages name them, and the
# kinds each declared type takes. A boolean is an integer to the source of these rules, and so it is here.
_NAMES = {"STR": "str", "BIG": "int", "DOU": "float", "DEC": "float", "FLO": "float", "BOO": "bool", "OBJ": "dict", "ARR": "list", "VOI": "NoneType"}
_TAKES = {"string": ["str"], "integer": ["int", "bool"], "number": ["int", "float", "bool"], "boolean": ["bool"], "object": ["dict"], "array": ["list"]}


def _text(value: str) -> str:
    """A string as an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _list(values: list[str]) -> str:
    return ", ".join(_text(v) for v in values)


_KINDS = "map(" + ", ".join(f"{_text(k)}, {_text(v)}" for k, v in _NAMES.items()) + ")"


def _kind(value: str) -> str:
    """The kind of a variant; only its outermost level matters. An integer too long for a long is a
    decimal without places."""
    schema = f"schema_of_variant({value})"
    return f"CASE WHEN {schema} RLIKE '^DECIMAL[(][0-9]+,0[)]$' THEN 'int' ELSE coalesce(element_at({_KINDS}, substring({schema}, 1, 3)), 'NoneType') END"


def _rule(rule: dict | None) -> str:
    """A field's rule as a struct literal; every rule has the same shape."""
    rule = rule or {}
    strings = lambda values: f"array({_list(values)})" if values else "CAST(NULL AS ARRAY<STRING>)"
    allowed = "[" + ", ".join(f"'{v}'" for v in rule.get("enum", [])) + "]"
    number = lambda bound: f"CAST({rule.get(bound, 'NULL')} AS DOUBLE)"
    shown = lambda bound: _text(str(rule.get(bound, "")))
    return (
        f"named_struct('type', {_text(rule.get('type', ''))}, 'takes', {strings(_TAKES.get(rule.get('type', ''), []))}, 'enum', {strings(rule.get('enum'))}, "
        f"'allowed', {_text(allowed)}, 'low', {number('minimum')}, 'low_text', {shown('minimum')}, 'high', {number('maximum')}, 'high_text', {shown('maximum')})"
    )


_SHOWN = "CASE x.kind WHEN 'NoneType' THEN 'None' WHEN 'bool' THEN initcap(x.raw) ELSE x.raw END"
_FIELD_ERRORS = f"""array_remove(array(
  CASE WHEN x.r.takes IS NULL OR array_contains(x.r.takes, x.kind) THEN '' ELSE concat('Field ', x.name, ': expected ', x.r.type, ', got ', x.kind) END,
  CASE WHEN x.r.enum IS NULL OR (x.kind = 'str' AND array_contains(x.r.enum, x.raw)) THEN '' ELSE concat('Field ', x.name, ': value \\'', {_SHOWN}, '\\' not in allowed values ', x.r.allowed) END,
  CASE WHEN x.number < x.r.low THEN concat('Field ', x.name, ': value ', {_SHOWN}, ' below minimum ', x.r.low_text) ELSE '' END,
  CASE WHEN x.number > x.r.high THEN concat('Field ', x.name, ': value ', {_SHOWN}, ' above maximum ', x.r.high_text) ELSE '' END), '')"""


def _missing(schema: dict) -> str:
    """Required fields the event lacks, in schema order."""
    return f"transform(array_except(array({_list(schema['required'])}), __k), n -> concat('Missing required field: ', n))"


def validate_events(df: DataFrame, json: str, versions: dict[str, dict] = USER_EVENT, newer_key: str = "source") -> DataFrame:
    """Add (schema_version, errors, valid). An event with ``newer_key`` is held to v2, else to v1.

    A missing key and a null are different things. Text that is no JSON object is an error of
    its own. Unknown fields pass. The text is parsed once into one variant per declared field;
    errors are required fields in schema order, then fields in the event's order. Rules are
    data next to each field, so one small expression judges all of them.
    """
    old, new = versions["v1"], versions["v2"]
    fields = list({**old["properties"], **new["properties"]})
    parsed = df.select("*", F.from_json(json, ", ".join(f"`{f}` variant" for f in fields)).alias("__f"), F.json_object_keys(json).alias("__k"))
    read = parsed.selectExpr(
        "*", f"coalesce(array_contains(__k, {_text(newer_key)}), false) AS __newer",
        *[f"{_kind(f'__f.`{f}`')} AS `__kind_{f}`" for f in fields],
        *[f"try_variant_get(__f.`{f}`, '$', 'string') AS `__raw_{f}`" for f in fields],
    )
    items = ", ".join(
        f"named_struct('p', array_position(__k, {_text(f)}), 'name', {_text(f)}, 'kind', `__kind_{f}`, 'raw', `__raw_{f}`, "
        f"'number', CASE `__kind_{f}` WHEN 'int' THEN try_cast(`__raw_{f}` AS DOUBLE) WHEN 'float' THEN try_cast(`__raw_{f}` AS DOUBLE) WHEN 'bool' THEN CAST(try_cast(`__raw_{f}` AS BOOLEAN) AS DOUBLE) END, "
        f"'r', CASE WHEN __newer THEN {_rule(new['properties'].get(f))} ELSE {_rule(old['properties'].get(f))} END)"
        for f in fields
    )
    listed = read.selectExpr(*[f"`{c}`" for c in df.columns], "__k", "__newer", f"sort_array(array({items})) AS __items")
    # One row comes of a generator as it went in, but no filter on its columns moves below it: moved down
    # to the scan, a filter on the errors would have the text parsed again for every use of a field.
    judged = listed.selectExpr(
        *[f"`{c}`" for c in df.columns],
        "inline(array(named_struct('schema_version', CASE WHEN __newer THEN 'v2' ELSE 'v1' END, "
        f"'errors', CASE WHEN __k IS NULL THEN array('Not a JSON object') ELSE concat(CASE WHEN __newer THEN {_missing(new)} ELSE {_missing(old)} END, "
        f"flatten(transform(__items, x -> CASE WHEN x.p > 0 THEN {_FIELD_ERRORS} ELSE array() END))) END)))",
    )
    return judged.withColumn("valid", F.size("errors") == 0)


def upgrade(validated: DataFrame, json: str) -> DataFrame:
    """Valid events in v2 form: a v1 event gets source "unknown" and a mark of where it came from.

    Values are read as validation saw them: a boolean id is valid there and is 1 or 0 here; an id
    beyond 64 bits becomes NULL.
    """
    rows = validated.filter("valid").withColumn("__v", F.try_parse_json(json))
    old = F.col("schema_version") == "v1"
    field = lambda name, kind: F.try_variant_get("__v", f"$.{name}", kind)
    return rows.withColumns({
        "event_id": field("event_id", "string"), "user_id": field("user_id", "long"), "event_type": field("event_type", "string"),
        "timestamp": field("timestamp", "string"), "source": F.when(old, "unknown").otherwise(field("source", "string")),
        "upgraded_from": F.when(old, "v1"),
    }).drop("__v")


def split_dead_letters(validated: DataFrame, root: str) -> None:
    """Valid and invalid rows in one write, under ``root/valid=true`` and ``root/valid=false``, so every
    event is judged once. It replaces what an earlier try left."""
    validated.write.mode("overwrite").partitionBy("valid").parquet(root)


def read_letters(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Rows that ``split_dead_letters`` wrote, with their ``valid`` flag; a filter on it prunes the files."""
    return spark.read.schema(f"{schema}, valid boolean").parquet(root)


def triage(df: DataFrame, retries: str = "retry_count", limit: int = 5) -> DataFrame:
    """Republish with one more retry below the limit, else a permanent failure."""
    again = F.coalesce(F.col(retries), F.lit(0)) < limit
    return df.withColumn("action", F.when(again, "republish").otherwise("permanent_failure")).withColumn(
        retries, F.when(again, F.coalesce(F.col(retries), F.lit(0)) + 1).otherwise(F.col(retries))
    )


def observed_fields(df: DataFrame, json: str, version: Column) -> DataFrame:
    """(version, field, required): required fields are those every event of the version has."""
    rows = df.select(version.alias("version"), F.json_object_keys(F.col(json)).alias("__k")).filter(F.col("__k").isNotNull())
    sizes = rows.groupBy("version").agg(F.count(F.lit(1)).alias("__n"))
    fields = rows.select("version", F.explode("__k").alias("field")).groupBy("version", "field").agg(F.count(F.lit(1)).alias("__f"))
    return fields.join(sizes, "version").select("version", "field", (F.col("__f") == F.col("__n")).alias("required"))


def compatibility(fields: DataFrame, old: str, new: str) -> DataFrame:
    """One row: a removed required field breaks backward compatibility; an added one is listed as
    breaking, leaves it alone, and makes the pair not forward compatible."""
    def required(version: str) -> Column:
        hit = (F.col("version") == version) & F.col("required")
        return F.array_sort(F.collect_set(F.when(hit, F.col("field"))))

    sides = fields.agg(required(old).alias("__o"), required(new).alias("__n"))
    sides = sides.select(F.array_except("__o", "__n").alias("removed"), F.array_except("__n", "__o").alias("added"))
    listed = lambda c: F.array_join(c, ", ")
    breaking = F.array_compact(F.array(
        F.when(F.size("removed") > 0, F.concat(F.lit("Removed required fields: "), listed("removed"))),
        F.when(F.size("added") > 0, F.concat(F.lit("New required fields: "), listed("added"))),
    ))
    return sides.select(
        (F.size("removed") == 0).alias("backward_compatible"), (F.size("added") == 0).alias("forward_compatible"),
        F.array_join(breaking, "; ").alias("breaking_changes"),
        listed("added").alias("new_fields"),
    )


def enforce_signature(df: DataFrame, signature: T.StructType | str) -> DataFrame:
    """The declared columns cast to the declared types. A missing column is an error at once, a
    value that does not fit fails the job."""
    declared = signature if isinstance(signature, T.StructType) else T.StructType.fromDDL(signature)
    lacking = [f.name for f in declared if f.name not in df.columns]
    if lacking:
        raise ValueError(f"missing columns {lacking}")
    columns = [F.col(f.name).cast(f.dataType) for f in declared]
    checked = [
        c.alias(f.name) if f.nullable else F.when(c.isNull(), F.raise_error(F.lit(f"null in required column {f.name}")).cast(f.dataType)).otherwise(c).alias(f.name)
        for c, f in zip(columns, declared, strict=True)
    ]
    return df.select(*checked)


def union_errors(validated: DataFrame) -> DataFrame:
    """How often each error occurs per version."""
    return validated.select("schema_version", F.explode("errors").alias("error")).groupBy("schema_version", "error").agg(F.count(F.lit(1)).alias("n"))
