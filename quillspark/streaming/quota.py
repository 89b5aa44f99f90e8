"""The token bucket as a stateful stream operator, keyed by deployment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.quota import Bucket

OUTPUT = "deployment string, ts double, tokens double, status int, granted boolean, wait double, multiplier double"
#: Rows that are Python's objects at a time; the others are numbers in arrays.
ROWS = 8192
STATE = "requests double, tokens double, last double, cooldown double, multiplier double"


def throttle(requests: DataFrame, rpm: float, tpm: float, batch_tokens: float) -> DataFrame:
    """Grants or waits for a stream of deployment, ts (seconds), tokens and status (200, or 429 for a refused call)."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        bucket = Bucket(rpm, tpm, batch_tokens, *(state.get if state.exists else (max(1.0, rpm / 6), max(batch_tokens, tpm / 6), 0.0, 0.0, 1.0)))
        held = [[f[c].to_numpy(dtype=kind, copy=True) for c, kind in (("ts", "f8"), ("tokens", "f8"), ("status", "i4"))] for f in frames]
        ts, tokens, status = (np.concatenate(c) for c in zip(*held, strict=True))
        del held
        order = np.lexsort((status, tokens, ts))
        for start in range(0, len(order), ROWS):
            part = order[start : start + ROWS]
            out = []
            for at, n, code in zip(ts[part].tolist(), tokens[part].tolist(), status[part].tolist(), strict=True):
                if code == 429:
                    bucket, wait = bucket.refused(at, 2.0), 0.0
                    granted = False
                else:
                    bucket, wait = bucket.ask(at, n)
                    granted = wait == 0
                    bucket = bucket.succeeded() if granted else bucket
                out.append((key[0], at, n, code, granted, wait, bucket.multiplier))
            state.update((bucket.requests, bucket.tokens, bucket.last, bucket.cooldown, bucket.multiplier))
            yield pd.DataFrame(out, columns=["deployment", "ts", "tokens", "status", "granted", "wait", "multiplier"])

    return requests.groupBy("deployment").applyInPandasWithState(run, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)
