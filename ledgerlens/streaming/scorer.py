"""Streaming scorer (P1-P10 on a stream): requests -> velocity state -> features -> decision.

Every micro-batch goes through the batch scorer (`operators.score.score_batch`)
with the state that earlier micro-batches left, so batch and stream cannot
disagree on features or policy. Rows outside the fraud universe and rows with
caller-supplied velocity read no state and do not advance it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..operators import score as SC
from .velocity import VelocityState, run_stateful


def score_stream(requests: DataFrame, prob: Column | str, threshold: float, out: str, state: str, ckpt: str, block_threshold: float | None = None) -> None:
    """Score every request of a stream that is there now; decisions go to `out`, the state to `state`."""
    def make(batch: DataFrame, history: DataFrame | None) -> DataFrame:
        return SC.score_batch(batch, prob, threshold, block_threshold, history=history)

    run_stateful(requests, make, out, VelocityState(requests.sparkSession, state), ckpt)
