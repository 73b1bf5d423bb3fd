"""Silver layer: map raw sources onto one canonical schema, clean, dedup.

One silver job per dataset is a single Spark plan:

    scan bulk text ─┐
                    ├─ unionByName ─ code filter ─ clean (one select) ─ distinct ─ write
    scan snapshots ─┘

The only shuffle is the distinct (a hash aggregate on the full row with
map-side pre-aggregation, so repeated rows collapse before they travel).
Two datasets fed by one bulk file (``itpas2.txt``) are built from one scan
and one distinct, labelled by a ``dataset`` column (``build_split_silver``).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import registry as R
from ..functions import rules
from ..sources.delimited import CORRUPT_COLUMN, read_delimited
from ..plans.joins import slices_for
from ..sources.paths import delete_path, path_exists
from ..sources.snapshots import read_snapshots
from ..sources.tables import REJECTED_PREFIX, REJECTED_SCHEMA, write_table
from ..sources.versions import row_hash

DATASET_COLUMN = "dataset"

#: Rejected lines: their columns, and the reason of a wrong field count.
REJECTED_COLUMNS = dict(c.split() for c in REJECTED_SCHEMA.split(", "))
BAD_FIELDS = "fields"
_FILE, _ID = "_origin_file", "_origin_id"


def project_mapping(
    df: DataFrame,
    mapping: Mapping[str, str],
    targets: list[str],
    as_text: bool = False,
    missing_tokens: tuple[str, ...] | None = None,
) -> DataFrame:
    """Rename source columns to canonical ones, in ``targets`` order.

    For each target the first mapped source column present in ``df`` wins;
    targets with no source become typed NULL text. ``as_text`` casts every
    value to string (snapshot sources); ``missing_tokens`` turns stringified
    missing values (``nan``/``None``) back into NULL.
    """
    return df.select(mapped_columns(df, mapping, targets, as_text, missing_tokens))


def mapped_columns(df: DataFrame, mapping: Mapping[str, str], targets: list[str], as_text: bool = False,
                   missing_tokens: tuple[str, ...] | None = None) -> list[F.Column]:
    """The columns of ``project_mapping``."""
    present = set(df.columns)
    cols = []
    for t in targets:
        src = next((k for k, v in mapping.items() if v == t and k in present), None)
        if src is None:
            c = F.lit(None).cast("string")
        else:
            c = F.col(f"`{src}`")
            if as_text:
                c = c.cast("string")
            if missing_tokens:
                c = rules.null_tokens(c, missing_tokens)
        cols.append(c.alias(t))
    return cols


def project_bulk(df: DataFrame, dataset: str) -> DataFrame:
    return project_mapping(df, R.MAPPINGS[dataset]["bulk"], R.target_columns(dataset))


def project_api(df: DataFrame, dataset: str, missing_tokens=("nan", "None")) -> DataFrame:
    return project_mapping(df, R.MAPPINGS[dataset]["api"], R.target_columns(dataset),
                           as_text=True, missing_tokens=missing_tokens)


def unify(bulk: DataFrame | None = None, api: DataFrame | None = None) -> DataFrame | None:
    """UNION ALL of the aligned sources; either may be absent (None when
    both are)."""
    parts = [p for p in (bulk, api) if p is not None]
    if not parts:
        return None
    return reduce(lambda a, b: a.unionByName(b), parts)


def code_filter(dataset: str) -> F.Column | None:
    """Row filter on the raw transaction type, or None (keep all)."""
    codes = R.DATASET_CODES.get(dataset)
    if not codes:
        return None
    return F.col("trans_type") == codes[0] if len(codes) == 1 else F.col("trans_type").isin(*codes)


def filter_codes(df: DataFrame, dataset: str) -> DataFrame:
    cond = code_filter(dataset)
    return df if cond is None else df.where(cond)


def clean_column(name: str, raw: F.Column | None = None) -> F.Column:
    """Cleaning rule chosen by column name, for the column itself or ``raw``."""
    raw = F.col(name) if raw is None else raw
    if name in R.DATE_COLUMNS:
        c = rules.normalize_date(raw)
    elif name in R.AMOUNT_COLUMNS:
        c = rules.normalize_amount(raw)
    elif name in R.ID_COLUMNS:
        c = rules.normalize_id(raw)
    elif name in R.LABEL_COLUMNS:
        c = rules.normalize_label(raw)
    else:
        c = rules.normalize_text(raw)
    return c.alias(name)


def clean(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One select applying the rule of every column; ``keep`` columns pass
    through untouched (e.g. the dataset label)."""
    return df.select(*[F.col(k) for k in keep],
                     *[clean_column(c) for c in df.columns if c not in keep])


def rejections(df: DataFrame) -> list[F.Column]:
    """Counters over raw canonical columns: values the cleaning rules cannot
    read (``bad_*``) and amounts with digits below the cent."""
    out = []
    for c in df.columns:
        if c in R.DATE_COLUMNS:
            out.append(F.count_if(rules.rejected_date(c)).alias(f"bad_{c}"))
        elif c in R.AMOUNT_COLUMNS:
            out += [F.count_if(rules.rejected_amount(c)).alias(f"bad_{c}"),
                    F.count_if(rules.sub_cent(c)).alias(f"sub_cent_{c}")]
    return out


def _counted(df: DataFrame, obs: Observation | None) -> DataFrame:
    metrics = rejections(df) if obs is not None else []
    return df.observe(obs, F.count(F.lit(1)).alias("candidate_rows"), *metrics) if obs is not None else df


def dedup(df: DataFrame) -> DataFrame:
    """DISTINCT over the whole row."""
    return df.dropDuplicates()


def silver_from_sources(dataset: str, bulk_raw: DataFrame | None, api_raw: DataFrame | None,
                        obs: Observation | None = None) -> DataFrame | None:
    """Align, unify, filter, clean and dedup already-read sources; ``obs``
    collects the rejection counters during the job."""
    rows = cleaned_from_sources(dataset, bulk_raw, api_raw, obs)
    return None if rows is None else dedup(rows)


def cleaned_from_sources(dataset: str, bulk_raw: DataFrame | None, api_raw: DataFrame | None,
                         obs: Observation | None = None) -> DataFrame | None:
    """The rows of ``silver_from_sources`` before equal ones are dropped."""
    bulk = project_bulk(bulk_raw, dataset) if bulk_raw is not None else None
    api = project_api(api_raw, dataset) if api_raw is not None else None
    unified = unify(bulk, api)
    if unified is None:
        return None
    return clean(_counted(filter_codes(unified, dataset), obs))


def distinct_pieces(rows: DataFrame, aside: str, buckets: int | None = None) -> Iterator[DataFrame]:
    """``dedup(rows)`` as frames that share no row, to be written one after the other, so that only one has
    shuffle files on disk. Several pieces are dealt once, as Parquet under ``aside``, by a hash of the row,
    with ``buckets`` by the row's bucket, and a piece's rows are deleted when the next one is asked for."""
    spark, n = rows.sparkSession, slices_for(rows)
    if n == 1:
        yield dedup(rows)
        return
    piece = F.pmod(row_hash(rows), F.lit(n)) if not buckets else F.pmod(F.hash(row_hash(rows)), F.lit(buckets)) % n
    write_table(rows.withColumn("_piece", piece.cast("int")), aside, ["_piece"], rebalance=False, compression="zstd")
    for i in range(n):
        part = f"{aside}/_piece={i}"
        if path_exists(spark, part):
            yield dedup(spark.read.schema(rows.schema).parquet(part))
            delete_path(spark, part)
        elif not i:  # a table without rows is written as well
            yield rows.limit(0)
    delete_path(spark, aside)


def read_bulk(spark: SparkSession, path: str | None, layout: str | list[str] | None,
              flag_corrupt: bool = True) -> DataFrame | None:
    if not path or layout is None:
        return None
    if path_exists(spark, path) is False:
        return None
    try:
        df = read_delimited(spark, path, layout, flag_corrupt=flag_corrupt)
        df.schema  # resolve the path now: a missing file skips the source
        return df
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return None
        raise


def build_silver(
    spark: SparkSession,
    dataset: str,
    bulk_path: str | None = None,
    landing_root: str | None = None,
    api_prefix: str | None = None,
    layout: str | list[str] | None = None,
) -> DataFrame | None:
    """Silver table of one dataset (lazy). ``layout`` defaults to the
    registered bulk file of the dataset. Returns None when neither source
    exists."""
    rows = cleaned_silver(spark, dataset, bulk_path, landing_root, api_prefix, layout)
    return None if rows is None else dedup(rows)


def cleaned_silver(spark: SparkSession, dataset: str, bulk_path: str | None = None, landing_root: str | None = None,
                   api_prefix: str | None = None, layout: str | list[str] | None = None) -> DataFrame | None:
    """The rows of ``build_silver`` before equal ones are dropped."""
    task = {d: (f, p) for d, f, p in R.SILVER_TASKS}.get(dataset)
    if layout is None and task:
        layout = task[0]
    if api_prefix is None and task:
        api_prefix = task[1]
    bulk_raw = read_bulk(spark, bulk_path, layout)
    api_raw = read_snapshots(spark, landing_root, api_prefix) if landing_root and api_prefix else None
    return cleaned_from_sources(dataset, bulk_raw, api_raw)


def build_split_silver(
    bulk_raw: DataFrame | None,
    api_raw: Mapping[str, DataFrame | None],
    datasets: tuple[str, ...] = ("committee_contributions_to_candidates", "independent_expenditures"),
    obs: Observation | None = None,
) -> DataFrame:
    """Several datasets cut from one bulk source by transaction code, built
    with one scan of the bulk file and one distinct.

    Each row is labelled with the dataset whose code filter it passes (the
    code sets must be disjoint); snapshot rows of a dataset can only land in
    that dataset. Output: ``dataset`` + the common canonical columns.
    """
    targets = R.target_columns(datasets[0])
    for d in datasets[1:]:
        if R.target_columns(d) != targets:
            raise ValueError("split datasets must share their canonical columns")
    seen: set[str] = set()
    for d in datasets:
        codes = set(R.DATASET_CODES.get(d, ()))
        if not codes or codes & seen:
            raise ValueError("split datasets need disjoint, non-empty code sets")
        seen |= codes

    parts = []
    if bulk_raw is not None:
        bulk = project_mapping(bulk_raw, R.MAPPINGS[datasets[0]]["bulk"], targets)
        label = F.lit(None).cast("string")
        for d in reversed(datasets):
            label = F.when(code_filter(d), F.lit(d)).otherwise(label)
        parts.append(bulk.select(label.alias(DATASET_COLUMN), *targets))
    for d in datasets:
        raw = api_raw.get(d)
        if raw is not None:
            api = project_api(raw, d)
            parts.append(api.select(F.when(code_filter(d), F.lit(d)).alias(DATASET_COLUMN), *targets))
    if not parts:
        raise ValueError("no source for the split datasets")
    unified = reduce(lambda a, b: a.unionByName(b), parts).where(F.col(DATASET_COLUMN).isNotNull())
    return dedup(clean(_counted(unified, obs), keep=(DATASET_COLUMN,)))


def with_origin(df: DataFrame | None) -> DataFrame | None:
    """A source as it was read, with the file of each row and a number that
    tells equal lines apart; needed by ``silver_and_rejected``."""
    if df is None:
        return None
    return df.select("*", F.col("_metadata.file_path").alias(_FILE), F.monotonically_increasing_id().alias(_ID))


def _whole_line(df: DataFrame, sep: str = "|") -> F.Column:
    """The line a raw row was read from: a malformed one as it stood, another
    one from its fields (quoting is off); a snapshot row as JSON."""
    names = [c for c in df.columns if c not in (CORRUPT_COLUMN, _FILE, _ID)]
    if CORRUPT_COLUMN not in df.columns:
        return F.to_json(F.struct(*(F.col(f"`{c}`") for c in names)))
    return F.coalesce(CORRUPT_COLUMN, F.concat_ws(sep, *(F.coalesce(f"`{c}`", F.lit("")) for c in names)))


def _rows_and_lines(df: DataFrame, datasets: tuple[str, ...], api: bool) -> DataFrame:
    """A raw source as cleaned rows and rejected lines, each under its label.

    A row goes to the first of ``datasets`` whose code filter it passes. Its
    line is rejected too if a value could not be read; a line with the wrong
    number of fields is rejected whether its row passes a filter or not."""
    targets = R.target_columns(datasets[0])
    mapping = R.MAPPINGS[datasets[0]]["api" if api else "bulk"]
    raw = dict(zip(targets, mapped_columns(df, mapping, targets, api, ("nan", "None") if api else None)))
    label = F.lit(None).cast("string")
    for d in reversed(datasets):
        codes = R.DATASET_CODES.get(d)
        label = F.when(raw["trans_type"].isin(*codes), F.lit(d)).otherwise(label) if codes else F.lit(d)
    ragged = F.col(CORRUPT_COLUMN).isNotNull() if CORRUPT_COLUMN in df.columns else F.lit(False)
    # cleaned once, used by the row and by the reason
    base = df.select("*", label.alias("_label"), ragged.alias("_ragged"),
                     *(clean_column(t, raw[t]).alias(f"_clean_{t}") for t in targets))
    reasons = [F.when(F.col("_ragged"), F.lit(BAD_FIELDS))]
    for t in targets:
        if t in R.DATE_COLUMNS:
            bad = (F.trim(raw[t]) != "") & F.col(f"_clean_{t}").isNull()
        elif t in R.AMOUNT_COLUMNS:
            bad = (F.col(f"_clean_{t}") == 0) & rules.rejected_amount(raw[t])
        else:
            continue
        reasons.append(F.when(F.col("_label").isNotNull() & bad, F.lit(t)))
    reason = F.concat_ws(",", *reasons)
    types = {t: "double" if t in R.AMOUNT_COLUMNS else "string" for t in targets}
    row = F.struct(F.col("_label").alias(DATASET_COLUMN), *(F.col(f"_clean_{t}").alias(t) for t in targets),
                   *(F.lit(None).cast(kind).alias(c) for c, kind in REJECTED_COLUMNS.items()))
    line = F.struct(F.concat(F.lit(REJECTED_PREFIX), F.coalesce("_label", F.lit(datasets[0]))).alias(DATASET_COLUMN),
                    *(F.lit(None).cast(types[t]).alias(t) for t in targets),
                    reason.alias("reason"), _whole_line(df).alias("line"), F.col(_FILE).alias("file"),
                    F.col(_ID).alias("line_id"))
    both = F.array(F.when(F.col("_label").isNotNull(), row), F.when(reason != "", line))
    # the outer form: for the inner one the optimizer infers a filter that repeats the whole expression
    return base.select(both.alias("_both")).select(F.inline_outer("_both")).where(F.col(DATASET_COLUMN).isNotNull())


def silver_and_rejected(bulk_raw: DataFrame | None, api_raw: Mapping[str, DataFrame | None],
                        datasets: tuple[str, ...], obs: Observation | None = None) -> DataFrame:
    """The silver rows of the datasets cut from one bulk source, and the lines
    that a user has to look at, in one pass: one scan per source and one
    distinct. Sources come through ``with_origin``.

    Output: ``dataset``, the canonical columns, ``REJECTED_COLUMNS``. Rows are
    labelled with their dataset and are those of ``silver_from_sources`` or
    ``build_split_silver``. Lines are labelled ``rejected_`` and the dataset
    (the first one if their row passes no code filter) and hold the whole
    line, why it was rejected (``fields``: wrong number of fields; else the
    names of the columns that could not be read), its file, and a number that
    is unique within the file and one run. ``obs`` counts as in
    ``silver_from_sources``."""
    parts = [] if bulk_raw is None else [_rows_and_lines(bulk_raw, datasets, api=False)]
    parts += [_rows_and_lines(api_raw[d], (d,), api=True) for d in datasets if api_raw.get(d) is not None]
    if not parts:
        raise ValueError("no source")
    out = reduce(lambda a, b: a.unionByName(b), parts)
    if obs is not None:
        metrics = [F.count_if(F.col("reason").isNull()).alias("candidate_rows")]
        for c in R.target_columns(datasets[0]):
            if c in R.DATE_COLUMNS + R.AMOUNT_COLUMNS:
                metrics.append(F.count_if(F.array_contains(F.split("reason", ","), c)).alias(f"bad_{c}"))
            if c in R.AMOUNT_COLUMNS:
                metrics.append(F.count_if(rules.sub_cent(c) & F.col("reason").isNull()).alias(f"sub_cent_{c}"))
        out = out.observe(obs, *metrics)
    return dedup(out)


def layer_counts(bulk_raw: DataFrame | None, api_raw: DataFrame | None, silver: DataFrame) -> DataFrame:
    """Row counts of the raw bulk scan, the snapshot frame and the silver
    output, as one small DataFrame (each count is a global aggregate with
    per-partition partial counts)."""
    parts = []
    for name, df in (("bulk_raw", bulk_raw), ("api_raw", api_raw), ("silver", silver)):
        if df is not None:
            parts.append(df.select(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("rows")))
    return reduce(lambda a, b: a.unionByName(b), parts)

