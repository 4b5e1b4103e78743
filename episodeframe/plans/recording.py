"""Recording -> aligned frames with state and next-state action.

The bag route end to end: sampling window (A2) -> frame grid (O2) ->
alignment (J1-J5) -> vector build (F8/F9) -> next-state action (W1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodeframe.functions.vectors import FieldSpec, build_vector, missing_mask
from episodeframe.operators import align as A
from episodeframe.operators.actions import next_state
from episodeframe.session import cut_lineage


def aligned_frames(messages: DataFrame, methods: dict[str, str], step_ns: int,
                   payload: list[str] | None = None, max_frames: int | None = None,
                   window_streams: list[str] | None = None, keep_block: bool = False) -> DataFrame:
    """Frames on the regular grid of each recording with every stream
    aligned by its method.  The sampling window is taken over the aligned
    streams (or ``window_streams``), as the reference does over every
    non-empty configured stream."""
    streams = list(window_streams or methods)
    m = messages.where(F.col(A.STREAM).isin(streams) & F.col(A.TS).isNotNull())
    # One row per (recording, stream), written once: the window, the grid,
    # the frame assignment and the interpolation clamp all read it, so the
    # raw messages are scanned once for it (pruned to three columns).
    ext = cut_lineage(A.stream_extents(m))
    params = A.grid_params(A.window_from_extents(ext), step_ns, max_frames)
    n = A.frame_tasks(params)
    grid = A.frame_grid(params, partitions=n)
    return A.align_frames(messages, grid, A.AlignSpec(methods, payload or ["value"]), params=params,
                          keep_block=keep_block, extents=ext, partitions=n)


def state_action_frames(messages: DataFrame, layout: list[FieldSpec], methods: dict[str, str],
                        step_ns: int, payload: list[str] | None = None,
                        max_frames: int | None = None) -> DataFrame:
    """Aligned frames plus ``state`` (array<float>), its ``missing`` mask and
    ``action`` = next state (last frame repeats)."""
    fr = aligned_frames(messages, methods, step_ns, payload, max_frames, keep_block=True)
    fr = fr.withColumn("state", build_vector(fr, layout)).withColumn("missing", missing_mask(fr, layout))
    return next_state(fr, [A.REC], "frame_index", {"action": "state"})
