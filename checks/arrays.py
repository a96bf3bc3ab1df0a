"""Readers, writers and array chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

import graticule as g
from checks.common import rounded, rs, table
from graticule.session import scratch_path


def _round_trip(fmt):
    """Write events in one format and read them back."""

    def query(s, d):
        path = f"{scratch_path(s, 'table')}.{fmt}"
        g.write_table(table(s, d, "events"), path, fmt)
        back = g.read_table(s, path)
        return back.select("event_id", "ts", "user_id", "event_type", "value", "props")

    return query


def _partitioned(s, d):
    path = f"{scratch_path(s, 'table')}.parquet"
    g.write_table(table(s, d, "events"), path, "parquet", partition_by=["event_type"])
    return g.read_table(s, path).select("event_id", "ts", "user_id", "event_type", "value", "props")


def _several(s, d):
    """Three files, one of them without props, as one dataset."""
    events = table(s, d, "events")
    paths = []
    for i, (lo, hi) in enumerate([("2024-01-01", "2024-01-10"), ("2024-01-10", "2024-01-20"), ("2024-01-20", "2025-01-01")]):
        part = events.filter((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")))
        paths.append(f"{scratch_path(s, 'part')}.parquet")
        g.write_table(part.drop("props") if i == 1 else part, paths[-1])
    return g.read_many(s, paths).select("event_id", "ts", "user_id", "event_type", "value", "props")


def _axes(s, d):
    """Axes of the chunks, read off the data: vec_id as it is, rows and columns of each 8 x 8 chunk."""
    e = table(s, d, "embeddings")
    pos = e.select(F.explode(F.sequence(F.lit(0), F.size("embedding") - 1)).alias("p")).distinct()
    row = pos.select(F.floor(F.col("p") / 8).alias("idx")).distinct()
    column = pos.select((F.col("p") % 8).cast("bigint").alias("idx")).distinct()
    return {
        "row": row.withColumn("label", F.col("idx") * 10.0),
        "col": column.withColumn("label", F.col("idx") * 10.0 + 100.0),
    }


def _chunks(s, d):
    return table(s, d, "embeddings").select(
        F.array(F.col("vec_id").cast("int"), F.lit(0), F.lit(0)).alias("origin"),
        F.array(F.lit(1), F.lit(8), F.lit(8)).alias("shape"),
        F.col("embedding").cast("array<double>").alias("values"),
    )


def _gap(s, d, **more):
    """The label of row 2 is missing from its axis."""
    axes = _axes(s, d)
    axes["row"] = axes["row"].filter("idx <> 2")
    return g.flatten_chunks(_chunks(s, d), axes, ["vec_id", "row", "col"], "value", **more)


_GAP = "SELECT * REPLACE (CASE WHEN row = 20.0 THEN NULL ELSE row END AS row) FROM flat"


def _flat(s, d, **more):
    return g.flatten_chunks(_chunks(s, d), _axes(s, d), ["vec_id", "row", "col"], "value", **more)


def _grid(s, d):
    return g.Grid.from_chunks(_chunks(s, d), _axes(s, d), ["vec_id", "row", "col"])


QUERIES = {
    "s1_read_table": lambda s, d: g.read_table(s, f"{d}/lineitem.parquet"),
    "s2_read_many": _several,
    "s4_flatten_chunks": _flat,
    "s4_flatten_chunks_long_axis": lambda s, d: _flat(s, d, max_axis_rows=0),
    "s4_flatten_chunks_axis_gap": lambda s, d: _gap(s, d),
    "s4_flatten_chunks_axis_gap_long": lambda s, d: _gap(s, d, max_axis_rows=0),
    "s4_sel": lambda s, d: g.sel(_grid(s, d), row=30.0, col=[100.0, 170.0]),
    "s4_isel": lambda s, d: g.isel(_grid(s, d), row=-1, col=slice(2, 6)),
    "s7_to_matrix_chunks": lambda s, d: g.to_matrix(
        _flat(s, d).filter("col = 100"), "vec_id", "row", "value", values=[float(i * 10) for i in range(8)]
    ).select("vec_id", *[F.col(f"`{i * 10}.0`").alias(f"r{i * 10}") for i in range(8)]),
    "s8_write_csv": _round_trip("csv"),
    "s8_write_tsv": _round_trip("tsv"),
    "s8_write_json": _round_trip("json"),
    "s8_write_parquet": _round_trip("parquet"),
    "s8_write_partitioned": _partitioned,
    "s4_mean_field": lambda s, d: rounded(
        _grid(s, d).reduce("value", "vec_id", "mean"), "value", d=8
    ),
}

_FLAT = """
WITH flat AS (
  SELECT vec_id, CAST(pos // 8 AS DOUBLE) * 10.0 AS row, CAST(pos % 8 AS DOUBLE) * 10.0 + 100.0 AS col,
         CAST(value AS DOUBLE) AS value
  FROM (SELECT vec_id, UNNEST(embedding) AS value, GENERATE_SUBSCRIPTS(embedding, 1) - 1 AS pos FROM embeddings))
"""
_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"

ORACLE = {
    "s1_read_table": "SELECT * FROM lineitem",
    "s2_read_many": """
        SELECT event_id, ts, user_id, event_type, value,
               CASE WHEN ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' THEN NULL ELSE props END AS props
        FROM events""",
    "s4_flatten_chunks": _FLAT + "SELECT * FROM flat",
    "s4_flatten_chunks_long_axis": _FLAT + "SELECT * FROM flat",
    "s4_flatten_chunks_axis_gap": _FLAT + _GAP,
    "s4_flatten_chunks_axis_gap_long": _FLAT + _GAP,
    "s4_sel": _FLAT + "SELECT vec_id, col, value FROM flat WHERE row = 30 AND col IN (100, 170)",
    "s4_isel": _FLAT + "SELECT vec_id, col, value FROM flat WHERE row = 70 AND col BETWEEN 120 AND 150",
    "s7_to_matrix_chunks": _FLAT
    + "SELECT vec_id, "
    + ", ".join(f"AVG(value) FILTER (WHERE row = {i * 10}) AS r{i * 10}" for i in range(8))
    + " FROM flat WHERE col = 100 GROUP BY vec_id",
    "s8_write_csv": _EVENTS,
    "s8_write_tsv": _EVENTS,
    "s8_write_json": _EVENTS,
    "s8_write_parquet": _EVENTS,
    "s8_write_partitioned": _EVENTS,
    "s4_mean_field": _FLAT + f"SELECT row, col, {rs('AVG(value)', 8)} AS value FROM flat GROUP BY row, col",
}
