"""The stages from cleaned tables to the master feature table and the validation gate."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custoria import constants as K
from custoria.functions.columns import instant
from custoria.functions.quantiles import BOUNDED_ROWS
from custoria.operators import cleaning as C
from custoria.operators import exploration as E
from custoria.operators import features as X
from custoria.operators import scores as S
from custoria.operators import validation as Q
from custoria.operators.encoding import encode_auto
from custoria.operators.selection import mutual_information
from custoria.operators.split import split_report, split_stratified
from custoria.session import materialize
from custoria.sources.sinks import load_stage, save_stage, stage_manifest, write_csv

BIN_COLUMNS = ["age_group", "lifetime_segment", "value_segment", "activity_status", "engagement_level"]


def clean_all(datasets: dict[str, DataFrame], as_of, deep_clean: bool = True, earliest: str = K.EARLIEST_TRANSACTION) -> dict[str, DataFrame]:
    """Every dataset through the rules of its kind."""
    return {name: C.clean_dataset(name, df, as_of, deep_clean, earliest) for name, df in datasets.items()}


def _with_engagement(df: DataFrame, bounded_rows: int) -> DataFrame:
    """Score and level, computed on the key and the few source columns and joined back once."""
    sources = [c for c in ("purchase_frequency", "total_spent", "days_since_last_transaction", "avg_satisfaction") if c in df.columns]
    if not sources:
        return df
    # equal keys have equal sources, hence equal scores
    slim = S.engagement_score(df.select(X.KEY, *sources), bounded_rows).select(X.KEY, "engagement_score").dropDuplicates([X.KEY])
    return X.join_features(df, S.engagement_level(materialize(slim), bounded_rows))


def master_features(
    cleaned: dict[str, DataFrame], as_of, interactions_as_of=None, encode: bool = True,
    values: dict[str, dict[str, list[str]]] | None = None, bounded_rows: int = BOUNDED_ROWS,
) -> DataFrame:
    """One wide row per customer, as many rows as there are customers.

    Every source table is aggregated once. The transaction block is stored because the
    quantile edges, the ranks and the join all read it; the joined table is stored once,
    then the whole-column scores read only their columns of it.
    """
    values = values or {}
    out = cleaned["customers"]
    if "transactions" in cleaned:
        block = materialize(X.transaction_features(cleaned["transactions"], as_of, values.get("transactions"), bounded_rows))
        rfm = block.select(
            X.KEY, F.col("days_since_last_transaction").cast("bigint").alias("recency"),
            F.col("total_transactions").alias("frequency"), F.col("total_spent").alias("monetary"),
        )
        rfm = S.rfm_segment(S.rfm_scores(rfm, bounded_rows))
        out = X.join_features(X.join_features(out, block), rfm)
    if "interactions" in cleaned:
        block = X.interaction_features(cleaned["interactions"], interactions_as_of or as_of, values.get("interactions"), bounded_rows)
        out = X.join_features(out, block)
    if "marketing" in cleaned:
        out = X.join_features(out, X.marketing_features(cleaned["marketing"], values.get("marketing")))
    out = materialize(X.behavior_ratios(X.time_features(out)))
    if "total_spent" in out.columns:
        out = X.activity_status(S.value_segment(out, bounded_rows))
    out = _with_engagement(out, bounded_rows)
    out = X.fill_feature_nulls(S.health_score(out), BIN_COLUMNS)
    return encode_auto(out, skip=[X.KEY, *BIN_COLUMNS]) if encode else out


def collect_all(raw: dict[str, DataFrame], date_range=None) -> dict[str, DataFrame]:
    """Raw tables as later stages expect them, of the dates in ``date_range`` where it is given.

    Customers need an id and a registration date, are unique and churned by 0 unless they say so. Transactions are
    completed ones of more than 0; events without a customer, date or amount go; unrated contacts count as neutral.
    """
    out = {}
    for name, df in raw.items():
        has = set(df.columns)
        dated = {"customers": "registration_date", "transactions": "transaction_date", "interactions": "interaction_date", "marketing": "campaign_date"}.get(name)
        if date_range is not None and dated in has:
            df = df.where(F.col(dated).between(instant(date_range[0]), instant(date_range[1])))
        if name == "customers":
            missing = [c for c in ("customer_id", "registration_date") if c not in has]
            if missing:
                raise ValueError(f"customers lack {missing}")
            df = C.fix_types(C.dedup_by_key(df, ["customer_id"]), {"customer_id": "string", "registration_date": "timestamp_ntz"})
            df = df if "churned" in has else df.withColumn("churned", F.lit(0))
        elif name == "transactions":
            df = C.fix_types(df, {"customer_id": "string", "transaction_date": "timestamp_ntz", "total_amount": "double"})
            df = df.where(F.col("total_amount") > 0).dropna(subset=["customer_id", "transaction_date", "total_amount"])
            df = df.where(F.col("transaction_status") == "completed") if "transaction_status" in has else df
        elif name == "interactions":
            df = C.fix_types(df, {"customer_id": "string", "interaction_date": "timestamp_ntz"}).dropna(subset=["customer_id", "interaction_date"])
            df = df.withColumn("satisfaction_score", F.coalesce("satisfaction_score", F.lit(3))) if "satisfaction_score" in has else df
        out[name] = df
    return out


def explore(master: DataFrame, label: str = "churned", parallelism: int = 4) -> dict[str, DataFrame]:
    """The reports of a feature table, worked out side by side; those by class only where it has the label."""
    reports = {"overview": lambda: E.overview(master), "correlations": lambda: E.correlation_pairs(master), "categories": lambda: E.categorical_profile(master)}
    if label in master.columns:
        reports |= {
            "target": lambda: E.target_distribution(master, label), "numbers": lambda: E.numeric_profile(master, target=label), "t_tests": lambda: E.t_tests(master, label),
            "chi_square": lambda: E.chi_square_tests(master, label), "histograms": lambda: E.histograms(master, label),
        }
    else:
        reports["numbers"] = lambda: E.numeric_profile(master)
    with ThreadPoolExecutor(parallelism) as pool:
        return dict(zip(reports, pool.map(lambda build: materialize(build()), reports.values())))


def prepare(master: DataFrame, label: str = "churned", key: str = X.KEY) -> dict[str, DataFrame]:
    """Train, validation and test rows with the report of their sizes; without a label the features as they are."""
    if label not in master.columns:
        return {"features": master}
    parts = split_stratified(master, label, key)
    out = {name: parts.where(F.col("split") == name).drop("split") for name in K.SPLIT_SHARES}
    return out | {"split_report": split_report(parts, label)}


#: The stages and those whose tables they read.
STAGES = {"collected": (), "cleaned": ("collected",), "validated": ("cleaned",), "features": ("cleaned",), "explored": ("features",), "prepared": ("features",)}


def run_stages(
    raw: dict[str, DataFrame], as_of, root: str, interactions_as_of=None, earliest: str = K.EARLIEST_TRANSACTION,
    resume_from: str | None = None, label: str = "churned", date_range=None,
) -> dict[str, dict[str, DataFrame]]:
    """All stages in order, every one stored under ``root`` and then committed by its manifest.

    With ``resume_from`` the stages before it are read, if they were finished with the same parameters from
    the stages that are there now; any other is run again, and so are those built from it.
    """
    spark = next(iter(raw.values())).sparkSession
    first = list(STAGES).index(resume_from) if resume_from else 0
    settings = {
        "collected": {"tables": sorted(raw), "date_range": date_range}, "cleaned": {"as_of": as_of, "earliest": earliest}, "validated": {"as_of": as_of},
        "features": {"as_of": as_of, "interactions_as_of": interactions_as_of, "label": label}, "explored": {"label": label}, "prepared": {"label": label},
    }
    out: dict[str, dict[str, DataFrame]] = {}

    def tables(stage):
        return {name: df for name, df in out[stage].items() if name != "report"}

    def cleaned():
        datasets, report = C.clean_with_report(out["collected"], as_of, earliest)
        return datasets | {"report": report}

    def validated():
        checks = Q.validate(tables("cleaned"), as_of)
        summary = Q.validation_summary(checks)
        return {"checks": checks, "summary": summary, "gate": Q.validation_gate(summary)}

    def features():
        master = materialize(master_features(tables("cleaned"), as_of, interactions_as_of))
        if label not in master.columns:
            return {"master": master}
        importance = materialize(mutual_information(master, label))
        write_csv(importance.orderBy(F.desc("importance"), "feature").coalesce(1), f"{root}/features/importance_csv")  # one row per column
        return {"master": master, "importance": importance}

    builders = {
        "collected": lambda: collect_all(raw, date_range), "cleaned": cleaned, "validated": validated,
        "features": features, "explored": lambda: explore(out["features"]["master"], label), "prepared": lambda: prepare(out["features"]["master"], label),
    }
    ids: dict[str, str] = {}
    for i, (stage, sources) in enumerate(STAGES.items()):
        inputs, parameters = [ids[s] for s in sources], {k: str(v) for k, v in settings[stage].items()}
        done = stage_manifest(spark, root, stage) if i < first else None
        if done and (done.inputs, done.parameters) == (inputs, parameters):
            out[stage] = load_stage(spark, root, stage, list(done.rows))
        else:
            out[stage] = save_stage(builders[stage](), root, stage, inputs, parameters)
            done = stage_manifest(spark, root, stage)
        ids[stage] = done.id
    return out
