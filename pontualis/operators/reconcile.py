"""Comparing two layers, two loads or two snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.model import DELAYS, INSTANTS, NO_INSTANT, NO_REASON, PAIR_KEYS
from pontualis.operators.joins import distinct_keys
from pontualis.operators.profile import layer_counts
from pontualis.operators.rows import union_all

# Pair counts grow with the square of a group, past BIGINT for a hot key at 10^10 rows.
PAIR_COUNT = "decimal(38,0)"

ADDED, REMOVED, CHANGED, UNCHANGED = "ADICIONADA", "REMOVIDA", "ALTERADA", "INALTERADA"

_SCHEDULED = "partida_prevista"
_DERIVED = {
    "linhas_com_partida_prevista_data": "partida_prevista_data",
    "linhas_com_partida_prevista_hora": "partida_prevista_hora",
    "linhas_com_atraso_partida": "atraso_partida_min",
    "linhas_com_atraso_chegada": "atraso_chegada_min",
    "linhas_com_minutos_recuperados": "minutos_recuperados",
}


def count_conservation(parts: Mapping[str, DataFrame], whole: Mapping[str, DataFrame],
                       total: str = "soma_esperada") -> DataFrame:
    """One row: count of each part, their sum, count of the whole, and the difference."""
    (whole_name, whole_df), = whole.items()
    counts = layer_counts({**parts, whole_name: whole_df})

    def of(name: str) -> Column:
        return F.max(F.when(F.col("tabela") == name, F.col("total_registros")))

    row = counts.agg(*[of(name).alias(name) for name in (*parts, whole_name)])
    expected = sum((F.col(n) for n in parts), F.lit(0))
    row = row.withColumn("diferenca", expected - F.col(whole_name))
    return row if len(parts) == 1 else row.withColumn(total, expected)


def keyed_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], compare: str, *,
               names: tuple[str, str] = ("anterior", "atual"),
               changed: str = CHANGED, position: str | None = None,
               carry: Sequence[str] = ()) -> DataFrame:
    """FULL OUTER comparison of two relations that are unique on ``keys``.

    ``compare`` is matched null-safe.  With ``position`` (a column of ``right``) rows come
    in that order, those found only on the left last.  ``carry`` names columns of ``right``
    to bring along; see :func:`diff_rows` for more than one compared column.
    """
    before, after = names
    kept = list(dict.fromkeys([*keys, compare, *carry, *([position] if position else [])]))
    old = left.select(*keys, F.col(compare).alias(before), F.lit(True).alias("__old"))
    new = right.select(*kept).withColumnRenamed(compare, after).withColumn("__new", F.lit(True))
    status = (
        F.when(F.col("__old").isNull(), ADDED)
        .when(F.col("__new").isNull(), REMOVED)
        .when(~F.col(before).eqNullSafe(F.col(after)), changed)
        .otherwise(UNCHANGED)
    )
    diff = old.join(new, list(keys), "full").withColumn("status", status)
    if position:
        diff = diff.orderBy(F.col(position).asc_nulls_last(), *keys)
    return diff.select(*keys, before, after, "status", *carry)


def diff_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], compare: Sequence[str], *,
              carry: Sequence[str] = (), changed: str = CHANGED,
              position: str | None = None) -> DataFrame:
    """FULL OUTER comparison of several columns of two relations that are unique on ``keys``.

    Keys and values are matched null-safe.  ``alteracoes`` lists, in the order of ``compare``, the
    columns that differ, as ``coluna, antes, depois`` (texts); of a row found on one side only,
    those that it has a value for.  ``carry`` names columns to bring along from the right, or
    from the left where only that has the row.  With ``position`` (a column of ``right``) rows
    come in that order, those found only on the left last.
    """
    def side(df: DataFrame, name: str, *more: str) -> DataFrame:
        values = dict.fromkeys([*compare, *carry, *more])
        return df.select(F.struct(*keys).alias(f"{name}_key"), F.struct(*values).alias(name),
                         *[F.col(k).alias(f"{name}_{k}") for k in keys])

    old, new = side(left, "old"), side(right, "new", *([position] if position else []))
    match = [F.col(f"old_{k}").eqNullSafe(F.col(f"new_{k}")) for k in keys]
    joined = old.join(new, reduce(and_, match), "full")
    differing = [F.when(~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")), F.struct(
        F.lit(c).alias("coluna"), F.col(f"old.{c}").cast("string").alias("antes"),
        F.col(f"new.{c}").cast("string").alias("depois"))) for c in compare]
    changes = F.array_compact(F.array(*differing))
    status = (F.when(F.col("old_key").isNull(), ADDED).when(F.col("new_key").isNull(), REMOVED)
              .when(F.size(changes) > 0, changed).otherwise(UNCHANGED))
    if position:
        joined = joined.orderBy(F.col(f"new.{position}").asc_nulls_last(), F.col("old_key"))

    def either(column: str) -> Column:
        there = F.col("new_key").isNotNull()
        return F.when(there, F.col(f"new.{column}")).otherwise(F.col(f"old.{column}"))

    return joined.select(*[F.coalesce(f"new_{k}", f"old_{k}").alias(k) for k in keys],
                         *[either(c).alias(c) for c in carry], changes.alias("alteracoes"),
                         status.alias("status"))


def changes_text(changes: str | Column = "alteracoes") -> Column:
    """The changes of :func:`diff_rows` as one text, for reports."""
    def shown(value: Column) -> Column:
        return F.coalesce(value, F.lit("(vazio)"))

    return F.array_join(F.transform(changes, lambda c: F.concat(
        c["coluna"], F.lit(": "), shown(c["antes"]), F.lit(" -> "), shown(c["depois"]))), "; ")


def schema_as_rows(df: DataFrame) -> DataFrame:
    """Columns of ``df`` as a relation, for :func:`keyed_diff` and :func:`diff_rows`."""
    rows = [(f.name, f.dataType.simpleString(), i, f.metadata.get("comment"))
            for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(
        rows, "coluna string, tipo string, posicao int, comentario string")


def multiset_difference(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of either side that the other lacks, with the surplus count (+left, -right).

    One aggregation with map-side combine, so a hot group of copies shrinks before the
    shuffle.
    """
    signed = union_all([
        left.select(*columns).withColumn("saldo", F.lit(1)),
        right.select(*columns).withColumn("saldo", F.lit(-1)),
    ])
    return signed.groupBy(*columns).agg(F.sum("saldo").alias("saldo")).filter("saldo <> 0")


def _raw_measures() -> dict[str, Column]:
    marks = {f"bronze_{c}_str_null": F.col(c) == NO_INSTANT for c in INSTANTS}
    return {**marks, "bronze_justificativa_NA": F.col("codigo_justificativa") == NO_REASON}


def _typed_measures() -> dict[str, Column]:
    nulls = {f"silver_{c}_null_real": F.col(c).isNull() for c in INSTANTS}
    return {
        **nulls,
        "silver_justificativa_null": F.col("codigo_justificativa").isNull(),
        **{name: F.col(c).isNotNull() for name, c in _DERIVED.items()},
    }


PROFILE_COLUMNS = (
    *[f"bronze_{c}_str_null" for c in INSTANTS], "bronze_justificativa_NA",
    *[f"silver_{c}_null_real" for c in INSTANTS], "silver_justificativa_null",
    *[f"{c}_cast_ok" for c in INSTANTS],
    *_DERIVED, "total_linhas",
)


def transform_profile(raw: DataFrame, typed: DataFrame) -> DataFrame:
    """What typing did, counted per row on each layer on its own; no join, no fan-out."""
    before = raw.agg(*[F.count_if(c).alias(n) for n, c in _raw_measures().items()])
    after = typed.agg(
        *[F.count_if(c).alias(n) for n, c in _typed_measures().items()],
        *[F.count(c).alias(f"{c}_cast_ok") for c in INSTANTS],
        F.count(F.lit(1)).alias("total_linhas"),
    )
    both = before.unionByName(after, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in PROFILE_COLUMNS])


def reconcile_pairs(raw: DataFrame, typed: DataFrame,
                    keys: Sequence[str] = PAIR_KEYS) -> DataFrame:
    """The profile over all (raw, typed) pairs of the inner join on ``keys``.

    The keys repeat, so the join is many-to-many and a hot key alone would emit the square
    of its rows.  Within a key every raw row meets every typed row, so each pair count is
    a product of per-key counts: both sides are aggregated by key first and joined one to
    one.  Results equal the literal join's.
    """
    def counted(df: DataFrame, size: str, measures: dict[str, Column]) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias(size),
            *[F.count_if(c).alias(n) for n, c in measures.items()],
        )

    def product(a: str, b: str) -> Column:
        """Counts stay BIGINT through join and sort; only their product is wider."""
        return F.col(a).cast(PAIR_COUNT) * F.col(b).cast(PAIR_COUNT)

    raw_measures, typed_measures = _raw_measures(), _typed_measures()
    present = {f"bronze_{c}_texto": F.col(c) != NO_INSTANT for c in INSTANTS}
    typed_ok = {f"silver_{c}_ok": F.col(c).isNotNull() for c in INSTANTS}
    groups = counted(raw, "__raw", {**raw_measures, **present}).join(
        counted(typed, "__typed", {**typed_measures, **typed_ok}), list(keys), "inner"
    )
    products = {
        **{n: product(n, "__typed") for n in raw_measures},
        **{n: product(n, "__raw") for n in typed_measures},
        **{f"{c}_cast_ok": product(f"bronze_{c}_texto", f"silver_{c}_ok") for c in INSTANTS},
        "total_linhas": product("__raw", "__typed"),
    }
    return groups.agg(*[F.sum(products[c]).cast(PAIR_COUNT).alias(c) for c in PROFILE_COLUMNS])


def side_by_side(raw: DataFrame, typed: DataFrame, keys: Sequence[str] = PAIR_KEYS, *,
                 tie: str | None = None, n: int = 5) -> DataFrame:
    """The first ``n`` (raw, typed) pairs by scheduled departure, next to each other.

    The pairs needed belong to the first ``n`` keys that have a partner, in the order of each
    key's first typed row, for every earlier key has an earlier pair.  So only keys and what
    orders them are aggregated, shuffled and semi-joined; the ``n`` keys, broadcast, then
    fetch the rows from both sides.  ``tie``, a unique column of both sides, orders rows of
    the same instant.  Without one, ties are broken by the keys and the shown columns, so
    only equal pairs are interchangeable.
    """
    shown = (*INSTANTS, "codigo_justificativa")
    typed_order = [_SCHEDULED, *([tie] if tie else [*keys, *shown, "situacao_voo"])]
    lead = [_SCHEDULED, *([tie] if tie else [])]
    raw_order = [tie] if tie else [f"bronze_{c}" for c in shown]

    def first(df: DataFrame, *order: str) -> DataFrame:
        return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)

    starts = typed.groupBy(*keys).agg(F.min(F.struct(*lead)).alias("__lead"))
    paired = starts.join(distinct_keys(raw, *keys), list(keys), "left_semi")
    nearest = first(paired, "__lead", *keys).select(*keys)
    chosen = first(typed.join(F.broadcast(nearest), list(keys), "left_semi"), *typed_order)
    typed_side = chosen.select(
        *keys,
        *[F.col(c).cast("string").alias(f"silver_{c}") for c in shown],
        *[F.col(f"{c}_{part}").alias(f"silver_{c}_{part}")
          for c in INSTANTS[:2] for part in ("data", "hora")],
        *[F.col(c).alias(f"silver_{c}") for c in DELAYS],
        "situacao_voo", F.struct(*typed_order).alias("__typed_order"),
    )
    raw_side = raw.select(
        *keys, *[F.col(c).alias(f"bronze_{c}") for c in shown], *([tie] if tie else [])
    ).withColumn("__raw_order", F.struct(*raw_order))
    pairs = raw_side.drop(*([tie] if tie else [])).join(
        F.broadcast(typed_side), list(keys), "inner"
    )
    return first(pairs, "__typed_order", "__raw_order").drop("__typed_order", "__raw_order")
