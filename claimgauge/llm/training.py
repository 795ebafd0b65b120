"""Full-batch training of small models with gradients summed by Spark.

The examples are a bounded labelled sample in a written table; each step is one job in
which every partition returns its loss and gradient as one row. The driver holds the
parameters and the sums, never an example.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: loss and gradient of the examples of some frames under the parameters
Gradient = Callable[[np.ndarray, Iterator[pd.DataFrame]], tuple[float, np.ndarray]]


def fit(examples: DataFrame, gradient: Gradient, start: np.ndarray, steps: int, rate: float,
        ridge: np.ndarray | float, partitions: int = 6) -> np.ndarray:
    """Parameters after ``steps`` of Adam on mean loss plus ``ridge`` * parameters squared.

    ``examples`` has a column ``weight``; an empty table leaves ``start`` as it is.
    """
    total = examples.groupBy().sum("weight").first()[0]
    if not total:
        return start
    at, mean, square = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for step in range(1, steps + 1):
        def one(frames: Iterator[pd.DataFrame], now=at) -> Iterator[pd.DataFrame]:
            _, slope = gradient(now, frames)
            yield pd.DataFrame({"slope": [slope.astype("<f8").tobytes()]})

        sums = examples.coalesce(partitions).mapInPandas(one, "slope binary").collect()
        slope = sum(np.frombuffer(bytes(r["slope"]), "<f8") for r in sums) / total
        slope = slope + 2 * ridge * at
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        at = at - pace * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return at
