"""Table maintenance: keyed dedup, append, predicate update and merge.

Operators A5, A9, T3, K1-K6, K9, K10. Every operator returns the new table
as a DataFrame plus a one-row summary; nothing is written here
(``tidemark.sources.live`` writes). The flagging variants leave what a row's fate
was in the row, so a writer counts (``observe``) in the pass that writes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import updates
from tidemark.operators.rollup import match_condition


@dataclass
class Result:
    table: DataFrame
    summary: DataFrame
    removed: DataFrame | None = None


# --------------------------------------------------------------------------- A5 / A9 / T3 / K9
def dedup_order(time_field: str, tiebreak: Sequence[tuple[str, int]], id_col: str) -> list[Column]:
    """Time descending, then the caller's (field, +-1) tie-breaks; a
    tie-break on the time field changes its direction but not its place.
    The row id (ascending) closes every remaining tie deterministically."""
    order: dict[str, int] = {time_field: -1}
    for field, direction in tiebreak:
        if direction not in (1, -1):
            raise ValueError("a tie-break sorts by 1 (ascending) or -1 (descending)")
        order[field] = direction
    cols = [F.col(f).asc() if d == 1 else F.col(f).desc() for f, d in order.items()]
    if id_col not in order:
        cols.append(F.col(id_col).asc())
    return cols


def dedup_flags(
    df: DataFrame,
    group_fields: Sequence[str],
    time_field: str,
    *,
    id_col: str = "id",
    start: Any = None,
    end: Any = None,
    extra_match: Mapping[str, Any] | Column | None = None,
    sort_tiebreak: Sequence[tuple[str, int]] = (),
) -> DataFrame:
    """``df`` with ``_kept`` (first of its group among the rows in scope) and
    ``_removed`` (any other row in scope); rows out of scope are neither.

    Skew: the winner per group comes from ``row_number() == 1``, which Spark
    pre-limits map-side (partial ``WindowGroupLimit``), so a group holding a
    third of the table ships one row per task. One join on the unique row id,
    which is evenly spread, brings the winners back to the rows."""
    if not group_fields:
        raise ValueError("dedup without group fields would leave a single row of the table")
    cond = match_condition(extra_match, time_col=time_field, start=start, end=end)
    in_scope = F.lit(True) if cond is None else F.coalesce(cond, F.lit(False))
    scope = df if cond is None else df.filter(cond)
    w = Window.partitionBy(*group_fields).orderBy(*dedup_order(time_field, sort_tiebreak, id_col))
    winners = scope.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).select(F.col(id_col).alias("_winner"))
    flagged = df.withColumn("_in", in_scope).join(winners, F.col(id_col) == F.col("_winner"), "left")
    won = F.col("_winner").isNotNull()
    return flagged.withColumns({"_kept": F.col("_in") & won, "_removed": F.col("_in") & ~won}).drop("_in", "_winner")


def dedup_counts() -> list[Column]:
    """A9 over flagged rows."""
    return [F.count_if("_kept").cast("long").alias("matched_groups"), F.count_if("_removed").cast("long").alias("deleted_ids")]


def dedup(df: DataFrame, group_fields: Sequence[str], time_field: str, *, batch_delete_size: int = 1000, **scope: Any) -> Result:
    """Keep the first row of each group (in T3 order) among the rows in scope
    (``extra_match`` and the inclusive time range), remove the others."""
    check_batch(batch_delete_size)
    flagged = dedup_flags(df, group_fields, time_field, **scope)
    flags = ("_kept", "_removed")
    return Result(flagged.filter(~F.col("_removed")).drop(*flags), flagged.agg(*dedup_counts()), flagged.filter("_removed").drop(*flags))


def check_batch(size: int) -> None:
    if size <= 0:
        raise ValueError("a delete batch holds at least one id")


def delete_ids(df: DataFrame, ids: DataFrame, id_col: str = "id", batch_delete_size: int = 1000) -> DataFrame:
    """K9: remove the given ids in one anti join (batching has no meaning in
    a rewrite, but the size check stays)."""
    check_batch(batch_delete_size)
    return df.join(ids.select(id_col), on=id_col, how="left_anti")


# --------------------------------------------------------------------------- K1 / S5
def documents(spark: SparkSession, rows: Sequence[Mapping[str, Any]], schema: T.StructType) -> DataFrame:
    """Inline documents as a DataFrame with a fixed schema."""
    if not rows:
        raise ValueError("no rows to insert")
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def append(target: DataFrame, docs: DataFrame) -> Result:
    """K1: unordered insert; columns missing on either side become NULL."""
    if docs is None:
        raise ValueError("no rows to insert")
    table = target.unionByName(docs, allowMissingColumns=True)
    summary = docs.agg(F.count(F.lit(1)).cast("long").alias("inserted"))
    return Result(table, summary)


# --------------------------------------------------------------------------- K5
def update_where(
    spark: SparkSession,
    target: DataFrame,
    update_ops: Sequence[Mapping[str, Any]],
    *,
    id_col: str = "id",
    order: Sequence[Column] | None = None,
) -> Result:
    """K5: each op changes the *first* row matching its filter (``UpdateOne``;
    ``order``, default the row id ascending, says which is first); with
    ``upsert`` and no match a row is built from the filter's equality fields
    and the update, and stands behind all others. Ops see what earlier ops did.
    Updates may reach into arrays by ``array_filters`` (``tidemark.operators.updates``).

    One aggregation finds every op's first row at once (``min`` of a struct,
    partial aggregation map-side). The rows that ops change, one per op at most,
    are folded on the driver, where the ops come from; an op whose first row was
    changed so that it no longer matches looks for its next one. The result is the table
    without these rows, and these rows: a plan of one size for any number of ops.
    """
    edits = update_plan(spark, target, update_ops, id_col=id_col, order=order)
    return Result(edits.applied(target, id_col), edits.summary(spark))


@dataclass
class Edits:
    """What a list of updates comes to: the ids of changed rows, all changed and
    new rows as they shall be, and the counts of K6."""

    ids: list[Any]
    rows: DataFrame
    matched: int
    modified: int
    upserted: int

    def applied(self, target: DataFrame, id_col: str) -> DataFrame:
        kept = target
        if self.ids:
            id_type = target.schema[id_col].dataType
            gone = target.sparkSession.createDataFrame([(i,) for i in self.ids], T.StructType([T.StructField("_gone", id_type)]))
            kept = target.join(F.broadcast(gone), F.col(id_col) == F.col("_gone"), "left_anti")  # one row per op at most
        return kept.unionByName(self.rows, allowMissingColumns=True)

    def summary(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(self.matched, self.modified, self.upserted)], "matched long, modified long, upserted long")


def update_plan(
    spark: SparkSession, target: DataFrame, update_ops: Sequence[Mapping[str, Any]], *, id_col: str = "id", order: Sequence[Column] | None = None
) -> Edits:
    if not update_ops:
        raise ValueError("no updates given")
    for i, spec in enumerate(update_ops):
        updates.validate(i, spec)
    place = F.struct(*(list(order) if order else [F.col(id_col)]), F.col(id_col).alias("_id"))
    conds = [F.lit(True) if (c := match_condition(spec["filter"])) is None else c for spec in update_ops]
    row = target.agg(*[F.min(F.when(c, place)).alias(f"w{i}") for i, c in enumerate(conds)]).first()
    first = [None if row[f"w{i}"] is None else tuple(row[f"w{i}"]) for i in range(len(conds))]
    docs: dict[Any, dict] = {}

    def fetch(ids: set) -> None:
        for r in target.filter(F.col(id_col).isin(list(ids))).collect() if ids else []:
            docs[r[id_col]] = r.asDict(recursive=True)

    fetch({w[-1] for w in first if w is not None})
    changed: dict[Any, tuple] = {}  # id -> its place
    new: list[dict] = []
    matched = modified = 0
    for spec, cond, own in zip(update_ops, conds, first):
        hits = [at for i, at in changed.items() if updates.matches(docs[i], spec["filter"])]
        if own is not None and own[-1] in changed and own not in hits:
            r = target.filter(cond & ~F.col(id_col).isin(list(changed))).agg(F.min(place).alias("w")).first().w
            own = None if r is None else tuple(r)
            fetch({own[-1]} - set(docs) if own else set())
        if own is not None:
            hits.append(own)
        if hits:
            best = min(hits)
            doc, changed[best[-1]] = docs[best[-1]], best
        else:
            doc = next((d for d in new if updates.matches(d, spec["filter"])), None)
        if doc is None:
            if spec.get("upsert", False):
                new.append(updates.upserted(spec))
            continue
        before = updates.copied(doc)
        updates.apply(doc, spec)
        matched += 1
        modified += doc != before
    fields = list(target.schema.fields)
    known = {f.name for f in fields}
    for d in [*(docs[i] for i in changed), *new]:
        for name, v in d.items():
            if name not in known:
                known.add(name)
                fields.append(T.StructField(name, updates.type_of(v)))
    schema = T.StructType(fields)
    rows = [tuple(updates.cast(d.get(f.name), f.dataType) for f in fields) for d in [*(docs[i] for i in changed), *new]]
    return Edits(list(changed), spark.createDataFrame(rows, schema), matched, modified, len(new))


# --------------------------------------------------------------------------- K2-K4 / K6 / K7 / K10
def validate_merge(source: DataFrame, key_fields: Sequence[str], strategy: str, *, check_rows: bool = True) -> None:
    """Driver-side argument checks; with ``check_rows`` one aggregation
    looks for keys that occur twice in the source. A NULL in a key is a value like any other."""
    if strategy not in ("set", "replace"):
        raise ValueError(f"unknown way to merge: {strategy!r} (set or replace)")
    if not key_fields:
        raise ValueError("a merge needs at least one key column")
    missing = [k for k in key_fields if k not in source.columns]
    if missing:
        raise ValueError(f"the source has no column {', '.join(missing)} to merge by")
    if check_rows:
        twice = source.groupBy(*key_fields).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").count()
        if twice:
            raise ValueError(f"{twice} keys occur more than once in the merge source")


def merge(
    target: DataFrame,
    source: DataFrame,
    key_fields: Sequence[str],
    *,
    strategy: str = "set",
    upsert: bool = True,
    null_keeps_target: bool = False,
    check_rows: bool = True,
) -> Result:
    """K2/K3/K4 (+K7 with ``null_keeps_target``): keyed merge of ``source``
    into ``target`` by one full outer join on the keys.

    ``set``: a matched row takes the source value for every column in the
    source schema and keeps its other columns; with ``null_keeps_target`` a
    NULL source value keeps the target's (NaN-dropped fields of the marts).
    ``replace``: a matched row becomes the source row (target-only columns
    NULL). ``upsert=False`` drops source rows without a match. Summary K6:
    matched / modified / upserted counts.
    """
    flagged = merge_flags(target, source, key_fields, strategy=strategy, upsert=upsert, null_keeps_target=null_keeps_target, check_rows=check_rows)
    return Result(flagged.drop(*MERGE_FLAGS), flagged.agg(*merge_counts()))


def _comparable(c: Column, kind: T.DataType) -> Column:
    """Maps have no equality of their own: they are compared by their sorted entries."""
    if isinstance(kind, T.MapType) and "map<" not in kind.valueType.simpleString():
        return F.array_sort(F.map_entries(c))
    return F.to_json(F.struct(c)) if "map<" in kind.simpleString() else c


MERGE_FLAGS = ("_changed", "_in_t", "_in_s")


def merge_counts() -> list[Column]:
    """K6 over flagged rows."""
    matched, added = F.col("_in_t") & F.col("_in_s"), ~F.col("_in_t") & F.col("_in_s")
    return [F.count_if(c).cast("long").alias(n) for n, c in (("matched", matched), ("modified", F.col("_changed")), ("upserted", added))]


def merge_flags(
    target: DataFrame,
    source: DataFrame,
    key_fields: Sequence[str],
    *,
    strategy: str = "set",
    upsert: bool = True,
    null_keeps_target: bool = False,
    check_rows: bool = True,
) -> DataFrame:
    """The rows of ``merge`` with what became of them: ``_changed``, and whether
    the target (``_in_t``) and the source (``_in_s``) had them."""
    validate_merge(source, key_fields, strategy, check_rows=check_rows)
    keys = list(key_fields)
    t_cols = [c for c in target.columns if c not in keys]
    s_cols = [c for c in source.columns if c not in keys]
    t = target.select(
        *[F.col(k).alias(f"_tk_{k}") for k in keys], *[F.col(c).alias(f"_t_{c}") for c in t_cols], F.lit(True).alias("_t")
    )
    s = source.select(
        *[F.col(k).alias(f"_sk_{k}") for k in keys], *[F.col(c).alias(f"_s_{c}") for c in s_cols], F.lit(True).alias("_s")
    )
    # a NULL key matches a NULL key, as a document filter {k: null} does
    cond = None
    for k in keys:
        c = F.col(f"_tk_{k}").eqNullSafe(F.col(f"_sk_{k}"))
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    in_t, in_s = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    if not upsert:
        j = j.filter(in_t)

    out_cols: list[Column] = [F.when(in_t, F.col(f"_tk_{k}")).otherwise(F.col(f"_sk_{k}")).alias(k) for k in keys]
    changed = F.lit(False)
    all_cols = t_cols + [c for c in s_cols if c not in t_cols]
    for c in all_cols:
        tc = F.col(f"_t_{c}") if c in t_cols else F.lit(None)
        sc = F.col(f"_s_{c}") if c in s_cols else F.lit(None)
        if strategy == "replace":
            new = F.when(in_s, sc).otherwise(tc)
        elif c in s_cols:
            take = in_s & sc.isNotNull() if null_keeps_target else in_s
            new = F.when(take, sc).otherwise(tc)
        else:
            new = tc
        kind = (target if c in t_cols else source).schema[c].dataType
        changed = changed | (in_t & in_s & ~_comparable(tc, kind).eqNullSafe(_comparable(new, kind)))
        out_cols.append(new.alias(c))
    return j.select(*out_cols, changed.alias("_changed"), in_t.alias("_in_t"), in_s.alias("_in_s"))
