"""Action derivation queries (W1-W5) over frame tables built from
``events`` (one frame per event) and ``embeddings`` (one frame per vector)."""

from __future__ import annotations

from pyspark.sql import functions as F

from episodeframe.operators.actions import (delta_action, drop_last_frame, future_chunk,
                                            next_state, relative_to_first)
from episodeframe.operators.blocks import block_of, dense_index
from episodeframe.plans.catalog import r6, register
from episodeframe.session import cut_lineage
from episodeframe.sources.tables import events_as_messages, table

K = 32


def event_frames(spark, sf_dir):
    """One frame per event: episode = user, order = (ts, seq), state = [value]."""
    m = events_as_messages(spark, sf_dir)
    return cut_lineage(dense_index(m, ["recording_id"], ["ts_ns", "seq"], "frame_index").select(
        "recording_id", "frame_index", F.array(F.col("value")).alias("state")))


def embedding_frames(spark, sf_dir, width: int = 4):
    """One frame per vector: episode = label, order = vec_id, state = the
    first ``width`` elements as doubles."""
    e = table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("long").alias("recording_id"), F.col("vec_id"),
        F.slice("embedding", 1, width).cast("array<double>").alias("state"))
    return dense_index(e, ["recording_id"], ["vec_id"], "frame_index",
                       block_col=block_of("vec_id", 1 << 16)).drop("vec_id")


_CHUNK_COLS_SQL = ",\n       ".join(
    f"round(coalesce(lead(ff, {j + 1}) OVER w, lastff), 6) AS c{j:02d}" for j in range(K))


@register("future_chunk_k32", f"""
WITH f AS (SELECT user_id AS recording_id, value,
                  row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) - 1 AS frame_index
           FROM events),
g AS (SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY recording_id ORDER BY frame_index
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ff FROM f),
h AS (SELECT *, last_value(ff) OVER (PARTITION BY recording_id ORDER BY frame_index
                ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS lastff,
             lead(frame_index) OVER (PARTITION BY recording_id ORDER BY frame_index) AS nxt FROM g),
c AS (SELECT recording_id, frame_index, value, nxt,
       {_CHUNK_COLS_SQL}
      FROM h WINDOW w AS (PARTITION BY recording_id ORDER BY frame_index))
SELECT * EXCLUDE (value, nxt) FROM c WHERE nxt IS NOT NULL AND value IS NOT NULL""")
def future_chunk_k32(spark, sf_dir):
    """W2 + W3: next 32 states as the action, padded with the last one; the
    last frame of each episode is dropped."""
    fr = future_chunk(event_frames(spark, sf_dir), ["recording_id"], "frame_index", "state", k=K)
    fr = drop_last_frame(fr, ["recording_id"], "frame_index", action="action")
    return fr.select("recording_id", "frame_index", *[r6(F.col("action")[j]).alias(f"c{j:02d}")
                                                      for j in range(K)])


def _vec_sql(expr: str, prefix: str, n: int = 4) -> str:
    return ", ".join(f"round({expr.format(i=i + 1)}, 6) AS {prefix}{i}" for i in range(n))


@register("relative_delta_actions", f"""
WITH f AS (SELECT CAST(label AS BIGINT) AS recording_id,
                  row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_index,
                  CAST(embedding[1:4] AS DOUBLE[]) AS state FROM embeddings),
a AS (SELECT *, CASE WHEN lead(frame_index) OVER w IS NULL THEN state ELSE lead(state) OVER w END AS action
      FROM f WINDOW w AS (PARTITION BY recording_id ORDER BY frame_index)),
b AS (SELECT *, first_value(state) OVER w0 AS s0, first_value(action) OVER w0 AS a0
      FROM a WINDOW w0 AS (PARTITION BY recording_id ORDER BY frame_index
                           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT recording_id, frame_index, {_vec_sql('state[{i}] - s0[{i}]', 'rs')},
       {_vec_sql('(action[{i}] - a0[{i}]) - state[{i}]', 'ra')}
FROM b""")
def relative_delta_actions(spark, sf_dir):
    """W1 next-state action, W4 relative to the episode's first state and
    first action, W5 delta against the unshifted state."""
    fr = embedding_frames(spark, sf_dir)
    fr = next_state(fr, ["recording_id"], "frame_index", {"action": "state"})
    fr = fr.withColumn("state0", F.col("state"))
    fr = relative_to_first(fr, ["recording_id"], "frame_index", ["state", "action"])
    fr = fr.withColumn("action", delta_action(F.col("action"), F.col("state0")))
    return fr.select("recording_id", "frame_index",
                     *[r6(F.col("state")[i]).alias(f"rs{i}") for i in range(4)],
                     *[r6(F.col("action")[i]).alias(f"ra{i}") for i in range(4)])


@register("next_state_blocks", """
WITH e AS (SELECT CASE WHEN label % 3 = 0 THEN NULL ELSE CAST(label AS BIGINT) END AS episode, vec_id,
                  CAST(embedding[1] AS DOUBLE) AS x FROM embeddings),
i AS (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY vec_id) - 1 AS idx FROM e)
SELECT episode, idx, vec_id, coalesce(lead(x) OVER (PARTITION BY episode ORDER BY idx), x) AS action FROM i""")
def next_state_blocks(spark, sf_dir):
    """W1 across many small blocks, with a null episode key."""
    e = table(spark, sf_dir, "embeddings").select(
        F.when(F.col("label") % 3 != 0, F.col("label").cast("long")).alias("episode"), "vec_id",
        F.col("embedding")[0].cast("double").alias("x"))
    e = dense_index(e, ["episode"], ["vec_id"], "idx", block_col=block_of("vec_id", 64))
    return next_state(e, ["episode"], "idx", {"action": "x"}, block=8).select("episode", "idx", "vec_id", "action")
