"""A model over batches of rows: loaded once a worker, asked by the batch, whatever the frames that rows come in."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, FloatType, IntegerType

from . import raster

#: Rows a model sees at once.
BATCH = 64


def presence(load: Callable[[], Callable[[np.ndarray], np.ndarray]], decode: Callable[[bytes], np.ndarray], batch: int = BATCH, threshold: float = raster.TEXT_CONFIDENCE) -> Callable[[Column], Column]:
    """A column function from image bytes to whether a text detector finds text in them.

    ``load`` makes the detector, which takes a stack of inputs and gives a score map each (see ``raster.text_present``); it is
    called once a worker, so weights are read there and not sent with every task. What cannot be decoded, or makes the
    detector fail, has no text, and the other rows of its batch are asked again one by one.
    """

    def make() -> Callable[[np.ndarray], np.ndarray]:
        detector = load()

        def ask(images: np.ndarray) -> np.ndarray:
            out, ready = np.zeros(len(images), np.int32), []
            for i, data in enumerate(images):
                try:
                    ready.append((i, raster.detector_input(decode(bytes(data)))))
                except Exception:  # noqa: S112  the image's own failure
                    continue

            def found(some: list) -> None:
                maps = detector(np.stack([x for _, x in some]))
                for (i, _), m in zip(some, maps, strict=True):
                    out[i] = int(np.any(np.asarray(m) >= threshold))

            try:
                if ready:
                    found(ready)
            except Exception:  # one of them: each for itself
                for one in ready:
                    try:
                        found([one])
                    except Exception:  # noqa: S112
                        continue
            return out

        return ask

    ask = predict_batch_udf(make, return_type=IntegerType(), batch_size=batch)  # such a function gives no booleans
    return lambda data: ask(data) == 1


def scores(load: Callable[[], Callable[[np.ndarray], np.ndarray]], width: int, returns: DataType | None = None, batch: int = BATCH) -> Callable[[Column], Column]:
    """A column function from arrays of ``width`` numbers to a model's outputs: ``load()`` gives a function of (rows, width) to (rows,) or (rows, n)."""
    return predict_batch_udf(load, return_type=returns or ArrayType(FloatType()), batch_size=batch, input_tensor_shapes=[[width]])


def with_text(images: DataFrame, load: Callable, decode: Callable[[bytes], np.ndarray], batch: int = BATCH) -> DataFrame:
    """Adds ``has_text`` to rows with ``bytes``; a row without bytes has none."""
    has = presence(load, decode, batch)
    return images.withColumn("has_text", F.when(F.col("bytes").isNotNull(), has(F.coalesce("bytes", F.lit(b"")))).otherwise(False))
