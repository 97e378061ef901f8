"""Raw JSON dumps to a table of one row a key: the steps of process_table as one plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.dedup import byte_dedup, canonical_dedup, cdc_filter, cdc_watermark, find_event_time, latest_per_key, skip_known
from strata.operators.quality import all_null_guard, find_key
from strata.operators.reshape import extract_map, explode_to_child, sanitize_names
from strata.operators.schema import discover_schema, explode_payload, parse_payload, registry_union, sentinel_nulls
from strata.operators.triage import json_triage
from strata.operators.upsert import null_key_quarantine, parse_quarantine, write_route
from strata.functions.shared import stage

RUN_LOG = "run_id string, logged_at timestamp, bronze_table string, silver_name string, mode string, raw_rows bigint, deduped_rows bigint, cdc_rows bigint, repair_needed boolean, discovery_mode string, fields_discovered int, parsed_valid bigint, parsed_null bigint, quarantined_new bigint, note string, rung_stats string"


@dataclass
class Config:
    """How a raw table becomes a parent. ``key`` None: found in the data, or none."""

    bronze: str
    silver: str
    key: str | None = None
    free_text_keys: Sequence[str] = ()
    sentinels: Sequence[str] = ()
    event_times: Sequence[str] = ("date_updated", "updated_at", "date_created")
    map_prefix: str | None = None
    payload: str = "raw_data"
    insert_date: str = "insert_date"
    updated_at: str = "bronze_updated_at"


@dataclass
class Outcome:
    table: DataFrame
    route: str
    quarantined: DataFrame
    null_keys: DataFrame
    metrics: dict = field(default_factory=dict)


def parse_raw(raw: DataFrame, cfg: Config, *, registry: DataFrame | None = None, known: DataFrame | None = None, watermark=None) -> tuple[DataFrame, dict]:
    """(rows with payload_hash, rung and the struct ``parsed``, metrics): watermark, byte dedup, skip of known payloads, triage, discovery, typed parse and canonical dedup."""
    spark = raw.sparkSession
    seen = Observation("raw")
    rows = cdc_filter(raw, cfg.updated_at, watermark).observe(seen, F.count("*").alias("cdc_rows"))
    rows = byte_dedup(rows, cfg.payload, [F.col(cfg.insert_date).asc_nulls_last(), F.col(cfg.updated_at).asc_nulls_last()])
    if known is not None:
        rows = skip_known(rows, known, "payload_hash")
    rows = stage(json_triage(rows, cfg.payload, free_text_keys=cfg.free_text_keys), "triaged")
    schema = discover_schema(rows, "payload")
    element = schema.elementType if isinstance(schema, T.ArrayType) else schema
    fields = len(element) if isinstance(element, T.StructType) else 0
    if registry is not None and isinstance(element, T.StructType):
        element = registry_union(element, registry, cfg.silver)
        schema = T.ArrayType(element) if isinstance(schema, T.ArrayType) else element
    parsed = parse_payload(rows, "payload", schema)
    parsed = canonical_dedup(parsed, "payload", [F.col(cfg.updated_at).desc_nulls_last(), F.col("payload_hash")]).drop("canonical_hash")
    mix = rows.groupBy(F.coalesce("rung", F.lit("none")).alias("rung")).count()
    rungs = {r["rung"]: r["count"] for r in mix.collect()}
    metrics = {"cdc_rows": seen.get["cdc_rows"], "deduped_rows": sum(rungs.values()), "repair_needed": any(k not in ("1", "none") for k in rungs), "fields_discovered": fields, "rung_stats": rungs}
    return parsed, metrics


def process_table(raw: DataFrame, target: DataFrame | None, cfg: Config, *, quarantine: DataFrame | None = None, null_quarantine: DataFrame | None = None, registry: DataFrame | None = None, rebuild: bool = False) -> Outcome:
    """One run for one table: parse, quarantine, expand, latest row a key, and the write's route."""
    spark = raw.sparkSession
    wm = None if target is None or rebuild else cdc_watermark(target, cfg.updated_at)
    known = target.select("payload_hash") if target is not None and not rebuild and "payload_hash" in target.columns else None
    parsed, metrics = parse_raw(raw, cfg, registry=registry, known=known, watermark=wm)
    quarantine = quarantine if quarantine is not None else parsed.drop("parsed").limit(0)
    good, bad = parse_quarantine(parsed, quarantine)
    valid = Observation("valid")
    kept = good.observe(valid, F.count("*").alias("n")).select(F.col(cfg.insert_date).alias("bronze_insert_date"), F.col(cfg.updated_at).alias("bronze_updated_at"), "payload_hash", "parsed")
    flat = sanitize_names(explode_payload(kept))
    if cfg.sentinels:
        flat = sentinel_nulls(flat, cfg.sentinels)
    if cfg.map_prefix:
        flat = extract_map(flat, prefix=cfg.map_prefix)
    parked = Observation("parked")
    flat = stage(flat, "parent")
    bad = stage(bad.observe(parked, F.count("*").alias("n")), "unparsed")
    metrics |= {"parsed_valid": valid.get["n"], "parsed_null": metrics["rung_stats"].get("none", 0), "quarantined_new": parked.get["n"], "mode": "rebuild" if rebuild else "full" if target is None else "cdc"}
    all_null_guard(flat.drop("bronze_insert_date", "bronze_updated_at", "payload_hash"))
    key = cfg.key or find_key(flat.drop("payload_hash"), table=cfg.silver)
    null_keys = spark.createDataFrame([], "table_name string, pk_column string, payload_hash string, row_json string")
    if key:
        flat, null_keys = null_key_quarantine(flat, null_quarantine if null_quarantine is not None else null_keys, key, table=cfg.silver)
        event = find_event_time(flat.schema, cfg.event_times)
        order = [*([F.col(event).desc_nulls_last()] if event else []), F.col("bronze_insert_date").desc_nulls_last(), F.col("bronze_updated_at").desc_nulls_last(), F.col("payload_hash").desc()]
        flat = latest_per_key(flat, [key], order)
    route, table = write_route(None if rebuild else target, flat, key=key, watermark=wm, event_time=find_event_time(flat.schema, cfg.event_times)) if key else write_route(None if rebuild else target, flat, watermark=wm)
    return Outcome(table, route, bad, null_keys, metrics)


def rebuild_parent(raw: DataFrame, cfg: Config, *, dry_run: bool = False, **kw) -> Outcome | dict:
    """The parent from the full history; a dry run gives the counts alone."""
    out = process_table(raw, None, cfg, rebuild=True, **kw)
    return {"raw_rows": raw.count(), "versions": out.metrics["parsed_valid"], "rows": out.table.count()} if dry_run else out


def rebuild_child(parent: DataFrame, array_col: str, name: str, key: str, *, carry: Sequence[str] = (), dry_run: bool = False) -> DataFrame | dict:
    """A child table from the full parent, all fragments of each array; a dry run gives planned rows and skipped nulls."""
    if dry_run:
        n = parent.agg(F.sum(F.size(F.coalesce(array_col, F.array().cast(parent.schema[array_col].dataType)))).alias("planned"), F.sum(F.size(F.filter(F.coalesce(array_col, F.array().cast(parent.schema[array_col].dataType)), lambda x: x.isNull()))).alias("nulls")).first()
        return {"planned": n["planned"] or 0, "nulls": n["nulls"] or 0}
    return explode_to_child(parent, array_col, name, key, carry=carry)


def replay_quarantine(quarantine: DataFrame, target: DataFrame, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """(target with what parses now, what stays in quarantine): reads the parked payloads themselves, whatever the watermark."""
    out = process_table(quarantine.drop("payload_hash", "payload", "rung"), None, cfg)
    from strata.operators.upsert import upsert_by_key

    key = cfg.key or find_key(target, table=cfg.silver)
    event = find_event_time(out.table.schema, cfg.event_times)
    return upsert_by_key(target, out.table, key, event_time=event), quarantine.join(out.quarantined.select("payload_hash").distinct(), "payload_hash", "left_semi")


def run_log(spark: SparkSession, run_id: str, cfg: Config, metrics: dict, *, logged_at, raw_rows: int | None = None, note: str | None = None) -> DataFrame:
    """One row of telemetry for a run, whatever its outcome."""
    import json
    from datetime import datetime

    at = logged_at if isinstance(logged_at, datetime) else datetime.fromisoformat(str(logged_at))
    m = metrics
    row = (run_id, at, cfg.bronze, cfg.silver, m.get("mode"), raw_rows, m.get("deduped_rows"), m.get("cdc_rows"), m.get("repair_needed"), "full", m.get("fields_discovered"), m.get("parsed_valid"), m.get("parsed_null"), m.get("quarantined_new"), note, json.dumps(m["rung_stats"], sort_keys=True) if "rung_stats" in m else None)
    return spark.createDataFrame([row], RUN_LOG)


def run_tables(jobs: Sequence[tuple[DataFrame, DataFrame | None, Config]], *, run_id: str, logged_at, continue_on_error: bool = True) -> tuple[dict[str, Outcome], DataFrame]:
    """(outcomes by silver name, the run log): each table by itself; errors are logged, and raised unless told to go on."""
    done, logs = {}, []
    for raw, target, cfg in jobs:
        spark = raw.sparkSession
        try:
            done[cfg.silver] = process_table(raw, target, cfg)
            logs.append(run_log(spark, run_id, cfg, done[cfg.silver].metrics, logged_at=logged_at))
        except Exception as e:
            logs.append(run_log(spark, run_id, cfg, {}, logged_at=logged_at, note=f"failed: {e}"[:500]))
            if not continue_on_error:
                raise
    out = logs[0]
    for x in logs[1:]:
        out = out.unionByName(x)
    return done, out
