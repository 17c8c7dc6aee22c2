"""Query of the conversation repair, with its SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import repair
from logloom.llm.common import query, table

_SUMS = ("blank", "duplicate", "truncated", "illegal", "cost")
REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def damaged(turns: DataFrame) -> DataFrame:
    """Fixed faults of the contract, by a checksum of conversation and turn; nulls are one space."""
    space = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    )
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        F.pmod(F.crc32(name.cast("binary")), F.lit(20)).alias("_fault"),
    ).where("_fault <> 0")
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_fault") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation out of its pieces in order."""
    names = ["conv_id", *[f.split()[0] for f in REPORT.split(", ")]]
    kinds = [*[pa.int64()] * 6, pa.string(), pa.string()]
    conv, now, rows = None, None, []

    def done():
        gaps = now["max"] - now["min"] + 1 - now["turns"] if now["max"] is not None else 0
        sums = [now[c] for c in _SUMS]
        return [conv, min(gaps, 2**63 - 1), *sums, "".join(now["audit"]), now["sha"].hexdigest()]

    def packed(kind):
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), [kind, *kinds])], names=names)

    kind = pa.int64()
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for r in batch.to_pylist():
            if now is not None and r["conv_id"] != conv:
                rows.append(done())
                now = None
            if now is None:
                conv = r["conv_id"]
                now = dict.fromkeys((*_SUMS, "turns"), 0) | {"audit": [], "sha": hashlib.sha256(), "lines": 0}
                now |= {"min": None, "max": None, "initial": None}
            for c in _SUMS:
                now[c] += r[c]
            if r["max_turn"] is not None:
                now["turns"] += r["n_turns"] - (r["min_turn"] == now["max"])
                now["min"] = r["min_turn"] if now["min"] is None else now["min"]
                now["max"] = r["max_turn"]
            if now["initial"] is not None:
                now["illegal"] += now["initial"] + r["first_initial"] not in repair.LEGAL
            now["initial"] = r["last_initial"]
            now["audit"].append(r["audit"])
            for role, text in zip(r["roles"], r["texts"]):
                now["sha"].update(f"{'\n' if now['lines'] else ''}{role}:{text}".encode())
                now["lines"] += 1
        if rows:
            yield packed(kind)
            rows = []
    if now is not None:
        rows.append(done())
        yield packed(kind)


def report(pieces: DataFrame) -> DataFrame:
    """Counts, audit and a digest of every repaired conversation.

    Whole pieces are conversations already.  Pieces of the others are read in their order as a
    stream, as a digest must be.
    """
    kind = pieces.schema["conv_id"].dataType.simpleString()
    lines = F.array_join(F.transform(F.arrays_zip("roles", "texts"), lambda x: F.concat(x["roles"], F.lit(":"), x["texts"])), "\n")
    gaps = F.coalesce(F.col("max_turn") - F.col("min_turn") + 1 - F.col("n_turns"), F.lit(0).cast("bigint"))
    whole = pieces.where("whole").select(
        "conv_id", gaps.alias("gaps"), *_SUMS, "audit", F.sha2(lines.cast("binary"), 256).alias("repaired_sha256")
    )
    split = pieces.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "no")
    return whole.unionByName(split.mapInArrow(_joined, f"conv_id {kind}, {REPORT}"))


def repaired_conversations(turns: DataFrame) -> DataFrame:
    """Every conversation of the undamaged turns, those without turns after damage too."""
    found = report(repair.repair(damaged(turns))).withColumnRenamed("conv_id", "_conv")
    every = turns.select("conv_id").distinct()
    zero = {f.split()[0]: F.lit(0).cast("bigint") for f in REPORT.split(", ")[:6]}
    zero |= {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", *[F.coalesce(c, v).alias(c) for c, v in zero.items()]
    )


# The checksum of the name, bit by bit.
_CRC32 = """xor(list_reduce(
    list_prepend(4294967295, list_transform(
      string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(unicode(x) AS BIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"""

# Edges of the recurrence: a turn's kind and the state before it, to the letters, the state behind it and the cost.
# State 0 is nothing yet, 1 system, 2 user, 3 assistant; e is the last step behind all turns.
_OP11 = r"""
WITH RECURSIVE d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         CRC32 % 20 AS f
  FROM conversations
), r0 AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM d WHERE f <> 0
), r1 AS (
  SELECT conv_id, turn, role, text, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS cut,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again
  FROM r0
), r2 AS (
  SELECT *, CASE WHEN cut = '' THEN 'blank' WHEN again > 1 THEN 'duplicate'
                 WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         role[1:1] AS initial, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS pair
  FROM r1
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r2 GROUP BY conv_id
), ins(s, letters, t, cost, text) AS (VALUES
  (0, '', 0, 0, ''), (1, '', 1, 0, ''), (2, '', 2, 0, ''), (3, '', 3, 0, ''),
  (0, 'I', 2, 2, E'\nuser:'), (1, 'I', 2, 2, E'\nuser:'), (2, 'I', 3, 2, E'\nassistant:'), (3, 'I', 2, 2, E'\nuser:'),
  (0, 'II', 3, 4, E'\nuser:\nassistant:'), (1, 'II', 3, 4, E'\nuser:\nassistant:'),
  (2, 'II', 2, 4, E'\nassistant:\nuser:'), (3, 'II', 3, 4, E'\nuser:\nassistant:')
), act(kind, s, letter, t, cost, role) AS (
  SELECT k, s, 'D', s, 3, NULL FROM (VALUES ('s'), ('u'), ('a'), ('o'), ('x')) k(k), (VALUES (0), (1), (2), (3)) q(s)
  UNION ALL SELECT k, s, 'R', t, 2, role FROM (VALUES ('s'), ('u'), ('a'), ('o')) k(k),
    (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')) q(s, t, role)
  UNION ALL VALUES ('s', 0, 'K', 1, 0, NULL), ('u', 0, 'K', 2, 0, NULL), ('u', 1, 'K', 2, 0, NULL), ('u', 3, 'K', 2, 0, NULL),
    ('a', 2, 'K', 3, 0, NULL)
), edge AS (
  SELECT kind, ins.s, ins.letters || letter AS letters, act.t, ins.cost + act.cost AS cost, ins.text AS inserted, letter, role
  FROM ins JOIN act ON ins.t = act.s
), steps AS (
  SELECT conv_id, i, role, text, coalesce(fault = 'truncated', false) AS broken,
         CASE WHEN fault IN ('blank', 'duplicate') THEN 'x' WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'o' END AS kind
  FROM r2
), dp(conv_id, i, s, best) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, {'cost': CAST(0 AS BIGINT), 'audit': '', 'text': ''} FROM counts
  UNION ALL
  SELECT dp.conv_id, steps.i, edge.t, min({
           'cost': CAST(dp.best.cost + edge.cost + CASE WHEN broken AND letter <> 'D' THEN 1 ELSE 0 END AS BIGINT),
           'audit': dp.best.audit || letters,
           'text': dp.best.text || inserted || CASE WHEN letter = 'D' THEN '' ELSE chr(10) || coalesce(edge.role, steps.role) || ':' || steps.text END})
  FROM dp JOIN steps ON dp.conv_id IS NOT DISTINCT FROM steps.conv_id AND steps.i = dp.i + 1
  JOIN edge ON edge.kind = steps.kind AND edge.s = dp.s
  GROUP BY dp.conv_id, steps.i, edge.t
), ends AS (
  SELECT dp.conv_id, min({'cost': best.cost + ins.cost, 'audit': best.audit || letters, 'text': best.text || ins.text}) AS best
  FROM dp JOIN counts ON dp.conv_id IS NOT DISTINCT FROM counts.conv_id AND dp.i = counts.n
  JOIN ins ON ins.s = dp.s AND ins.t IN (0, 3)
  GROUP BY dp.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(best.text[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts ON c.conv_id IS NOT DISTINCT FROM counts.conv_id
LEFT JOIN ends ON c.conv_id IS NOT DISTINCT FROM ends.conv_id
""".replace("CRC32", _CRC32)


@query(_OP11)
def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after fixed damage."""
    return repaired_conversations(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
