"""Batch boundary to external models and codecs.

A model is a function from a list of request dicts to a list of answers. The
default is a deterministic stub, so that plans around a model run anywhere;
services, fonts, PDF and raster codecs are plugged in by the caller.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Model = Callable[[list[dict]], list[str | None]]

#: Kinds of boundary and the columns that a request of each holds.
CONTRACTS = {
    "chat": ("prompt", "system", "image"),
    "translate": ("text", "direction"),
    "image": ("prompt", "width", "height"),
    "ocr": ("image_path",),
    "detect": ("image_path",),
    "render": ("text", "width", "height", "font", "font_size"),
    "pdf_page": ("path", "page"),
    "pdf_images": ("path", "dpi"),
    "slides_to_pdf": ("path", "seconds"),
    "fetch": ("url", "seconds"),
    "font_file": ("file", "url"),
    "describe": ("image_path", "prompt"),
    "quality": ("image_path",),
    "page_image": ("boxes", "font"),
}


def stub(requests: list[dict]) -> list[str | None]:
    """An answer that depends on the request alone."""
    return [hashlib.sha256(repr(sorted(r.items())).encode()).hexdigest()[:16] for r in requests]


def request_key(*columns: str) -> Column:
    """The content address of a request: equal requests are asked once."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def call_model(df: DataFrame, kind: str, model: Model = stub, result: str = "answer", attempts: int = 5, wait: float = 0.0) -> DataFrame:
    """Add a model's answers, asked in Arrow batches with retries; a batch that fails for good has null answers, not missing rows."""
    inputs = [c for c in CONTRACTS[kind] if c in df.columns]

    @F.pandas_udf("string")
    def ask(rows: pd.DataFrame) -> pd.Series:
        requests = rows.to_dict("records")
        for attempt in range(attempts):
            try:
                return pd.Series(model(requests))
            except (OSError, RuntimeError):
                time.sleep(wait * 2**attempt)
        return pd.Series([None] * len(rows), dtype=object)

    return df.withColumn(result, ask(F.struct(*inputs)))


def call_once(df: DataFrame, kind: str, model: Model = stub, result: str = "answer", cache: DataFrame | None = None) -> DataFrame:
    """call_model for each distinct request that the cache does not hold; answers are joined back."""
    inputs = [c for c in CONTRACTS[kind] if c in df.columns]
    keyed = df.withColumn("_request", request_key(*inputs))
    distinct = keyed.select("_request", *inputs).dropDuplicates(["_request"])
    if cache is not None:
        distinct = distinct.join(cache, "_request", "left_anti")
    answers = call_model(distinct, kind, model, result).select("_request", result)
    if cache is not None:
        answers = answers.unionByName(cache.select("_request", result))
    return keyed.join(answers, "_request", "left").drop("_request")


def fetched(df: DataFrame, kind: str, model: Model = stub, result: str = "answer", cache: DataFrame | None = None) -> DataFrame:
    """call_once without the rows whose request failed or came back empty: for fetches, conversions and rasters that a row cannot do without."""
    return call_once(df, kind, model, result, cache).where(F.coalesce(F.col(result), F.lit("")) != "")


def missing_files(registry: DataFrame, files: DataFrame, force: bool = False) -> DataFrame:
    """Registry entries (file, url) still to be fetched: those whose file is not listed, or all if forced."""
    return registry if force else registry.join(files.select("file").distinct(), "file", "left_anti")


def _answered(df: DataFrame, column: str, kind: str, model: Model, result: str, **constants: str) -> DataFrame:
    """df with the trimmed answers to a request made of one column and constants, asked once a distinct value."""
    asked = CONTRACTS[kind][0]
    keys = df.select(F.col(column).alias(asked)).where(F.col(asked).isNotNull()).distinct()
    answers = call_model(keys.withColumns({k: F.lit(v) for k, v in constants.items()}), kind, model, result)
    answers = answers.select(F.sha2(F.col(asked), 256).alias("_asked"), F.trim(result).alias(result))
    return df.withColumn("_own", F.sha2(F.col(column), 256)).join(answers, F.col("_own") == F.col("_asked"), "left").drop("_own", "_asked")


def translated(df: DataFrame, text: str, direction: str, result: str, model: Model = stub) -> DataFrame:
    """A text's translation, trimmed; null where the text is null or the service failed."""
    return _answered(df, text, "translate", model, result, direction=direction)


def back_translated(df: DataFrame, text: str, result: str = "back", model: Model = stub) -> DataFrame:
    """An English text translated to Chinese and back, for comparison with itself."""
    there = translated(df, text, "en2zh", "_there", model)
    return translated(there, "_there", "zh2en", result, model).drop("_there")


def described(df: DataFrame, image: str, requests: dict[str, str], model: Model = stub) -> DataFrame:
    """One answer column for each request about an image; rows with an empty or missing answer go."""
    for result, prompt in requests.items():
        df = _answered(df, image, "describe", model, result, prompt=prompt).where(F.coalesce(F.col(result), F.lit("")) != "")
    return df
