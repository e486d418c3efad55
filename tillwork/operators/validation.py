"""The rule engine for imports, and the reports on what it decided.

Rules run in order and stop at the first rejection; repairs seen before that are still
reported. Everything is one projection: no rule causes a pass of its own. Only the
lookups (does the parent exist, is the key taken) need joins, and those are prepared
beforehand as flag columns by ``mark_parent`` and ``mark_key``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillwork import schema as S
from tillwork.functions.rules import Rule
from tillwork.operators.skew import own_exchange

ISSUE = ("struct<regla:string,campo:string,valor:string,problema:string,accion:string,severidad:string>")


def mark_parent(df: DataFrame, key: Column, parent: DataFrame, parent_key: str, flag: str) -> DataFrame:
    """Adds ``flag``: whether ``key`` occurs in the parent table.

    The parent side is reduced to one row per key, so no row multiplies; whether it is
    broadcast is left to the optimiser, which knows its size.
    """
    known = own_exchange(parent.select(F.col(parent_key).alias("_pk")).distinct(), "_pk").withColumn(flag, F.lit(True))
    return (df.withColumn("_fk", key).join(known, F.col("_fk") == F.col("_pk"), "left")
            .drop("_fk", "_pk").withColumn(flag, F.coalesce(flag, F.lit(False))))


def mark_key(df: DataFrame, key: Column, target_keys: DataFrame, target_key: Column, row_id: str,
             eligible: Column, taken: str, repeated: str) -> DataFrame:
    """Adds ``taken`` (key already in the target) and ``repeated`` (an earlier row of this
    batch that would be accepted has the same key).

    ``eligible`` says whether a row passes every other rejecting rule. The batch is folded
    to one row per key before the target is looked up, so rows move once on their key, and
    a key shared by very many rows is split in that move. Both joins hash the key: the folded side has
    one row per key, and a sort would ask the collation for a key's bytes at every comparison.
    """
    known = target_keys.select(target_key.alias("_tk")).distinct().withColumn("_taken", F.lit(True))
    rows = df.withColumn("_key", key)
    # The filter is what the join implies for matches; missing keys never match anything.
    facts = (rows.where(F.col("_key").isNotNull()).groupBy("_key")
             .agg(F.min(F.when(eligible, F.col(row_id))).alias("_first"))
             .join(known.hint("shuffle_hash"), F.col("_key") == F.col("_tk"), "left")
             .select("_key", "_first", F.coalesce("_taken", F.lit(False)).alias("_taken")))
    return (rows.join(own_exchange(facts, "_key").hint("shuffle_hash"), "_key", "left")
            .withColumn(taken, F.coalesce("_taken", F.lit(False)))
            .withColumn(repeated, F.coalesce(~F.col("_taken") & (F.col(row_id) > F.col("_first")), F.lit(False)))
            .drop("_key", "_first", "_taken"))


def passes(rules: list[Rule]) -> Column:
    """True where no rejecting rule of the list fires."""
    return reduce(lambda acc, r: acc & ~F.coalesce(r.fails, F.lit(False)),
                  [r for r in rules if r.rejects], F.lit(True))


def validate(df: DataFrame, rules: list[Rule], parsed: dict[str, Column] | None = None) -> DataFrame:
    """Adds ``estado``, ``observacion`` and ``issues``, and puts repaired values in place.

    ``parsed`` gives the typed reading of a field; a repair replaces it where its rule fired.
    Rejected rows keep the text they arrived with in ``crudo``.
    """
    fired = [f"_r{i}" for i in range(len(rules))]
    flagged = df.select("*", *[F.coalesce(r.fails, F.lit(False)).alias(f) for r, f in zip(rules, fired)])

    rejected = F.lit(False)
    entries = []
    for rule, flag in zip(rules, fired):
        entry = F.struct(
            F.lit(rule.name).alias("regla"), F.lit(rule.field).alias("campo"),
            F.col(rule.field).cast("string").alias("valor"), rule.problem.alias("problema"),
            (F.lit(rule.action) if isinstance(rule.action, str) else rule.action).alias("accion"),
            F.lit("error" if rule.rejects else "warning").alias("severidad"),
        )
        entries.append(F.when(F.col(flag) & ~rejected, entry))
        if rule.rejects:
            rejected = rejected | F.col(flag)

    issues = F.filter(F.array(*entries), lambda x: x.isNotNull())
    judged = flagged.withColumn("issues", issues)
    estado = (F.when(rejected, S.ROW_ERROR).when(F.size("issues") > 0, S.ROW_FIXED).otherwise(S.ROW_OK))
    why = F.when(rejected, F.try_element_at("issues", F.lit(-1))["problema"]).when(
        F.size("issues") > 0, F.array_join(F.transform("issues", lambda x: x["problema"]), "; "))

    values = dict(parsed or {})
    for rule, flag in zip(rules, fired):
        if not rule.rejects:
            current = values.get(rule.field, F.col(rule.field))
            values[rule.field] = F.when(F.col(flag) & ~rejected, rule.repair).otherwise(current)
    raw = F.struct(*[F.col(c) for c in values]).alias("crudo") if values else F.lit(None).alias("crudo")
    keep = [values[c].alias(c) if c in values else F.col(c) for c in df.columns]
    return judged.select(*keep, estado.alias("estado"), why.alias("observacion"), "issues", raw)


def revalidate(validated: DataFrame, rules_of) -> DataFrame:
    """Runs the rules again over the rejected rows alone, from the text they arrived with.

    ``rules_of`` maps the restored rows to a validated frame, so corrected parents or
    targets are picked up without reading the file again.
    """
    rejects = validated.where(F.col("estado") == S.ROW_ERROR)
    restored = rejects.select(
        *[c for c in rejects.columns if c not in ("crudo", "issues", "estado", "observacion")
          and c not in rejects.schema["crudo"].dataType.names],
        "crudo.*")
    return rules_of(restored)


def load_valid(staged: DataFrame, target: T.StructType) -> DataFrame:
    """Accepted rows in the target's types; blank text becomes NULL."""
    kinds = dict(staged.dtypes)

    def fit(field):
        value = F.col(field.name)
        if kinds[field.name] == "string":
            value = F.nullif(F.trim(value), F.lit(""))
        return value.try_cast(field.dataType).alias(field.name)

    return staged.where(F.col("estado").isin(S.ROW_OK, S.ROW_FIXED)).select(*[fit(f) for f in target.fields])


def issue_log(validated: DataFrame, entity: str, row_id: str = "fila", label: Column | None = None) -> DataFrame:
    """One row per problem. Logs of several entities go together with ``unionByName``."""
    return validated.select(
        F.lit(entity).alias("entidad"), F.col(row_id),
        (label if label is not None else F.lit(None).cast("string")).alias("identificador"),
        "estado", F.explode("issues").alias("i"),
    ).select("entidad", row_id, "identificador", "estado", "i.*")


def status_counts(validated: DataFrame, entity: str) -> DataFrame:
    """Rows per status, one row each, in the order of the statuses."""
    order = F.array_position(F.array(*[F.lit(s) for s in S.ROW_STATES]), F.col("estado"))
    return (validated.groupBy("estado").agg(F.count("*").alias("cantidad"))
            .select(F.lit(entity).alias("entidad"), "estado", "cantidad").orderBy(order))


def status_names(validated: DataFrame, entity: str, label: Column, row_id: str = "fila") -> DataFrame:
    """The records behind the counts: one row each, with its status, in row order."""
    return validated.select(F.lit(entity).alias("entidad"), "estado", F.col(row_id), label.alias("registro")).orderBy(row_id)


def import_counters(validated: DataFrame, entity: str) -> DataFrame:
    state = F.col("estado")
    of = lambda s: F.size(F.filter("issues", lambda x: x["severidad"] == s))
    return validated.agg(
        F.count("*").alias("leidos"),
        F.count_if(state.isin(S.ROW_OK, S.ROW_FIXED)).alias("insertados"),
        F.count_if(state == S.ROW_ERROR).alias("descartados"),
        F.count_if(state == S.ROW_FIXED).alias("corregidos"),
        F.coalesce(F.sum(of("error")), F.lit(0)).alias("errores"),
        F.coalesce(F.sum(of("warning")), F.lit(0)).alias("advertencias"),
    ).select(F.lit(entity).alias("entidad"), "*")


def error_rate(validated: DataFrame, entity: str, threshold: float = 0.10) -> DataFrame:
    """Share of rejected rows in percent, and whether it is above the alarm threshold."""
    bad = F.count_if(F.col("estado") == S.ROW_ERROR)
    counted = validated.agg(F.count("*").alias("leidos"), bad.alias("errores"))
    share = F.col("errores") / F.nullif(F.col("leidos"), F.lit(0))
    return counted.select(
        F.lit(entity).alias("entidad"), "leidos", "errores",
        F.round(share * 100, 2).alias("pct_error"),
        F.coalesce(share > threshold, F.lit(False)).alias("alarma"))


def issue_types(log: DataFrame) -> DataFrame:
    return log.groupBy("entidad", "regla", "severidad").agg(F.count("*").alias("cantidad"))
