"""Statistics of page images as a DataFrame operator."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from folioscope.kernels import pages

#: Pixels that are held until they are measured together; a larger page is measured alone. Results don't depend on it.
PIXELS = 1 << 18


def raw_rgb(content: bytes, width: int, height: int) -> np.ndarray:
    """Pixels of an uncompressed RGB image."""
    return np.frombuffer(content, np.uint8).reshape(height, width, 3)


def measure(df: DataFrame, key: str = "path", decode: Callable[..., np.ndarray] = raw_rgb, columns: tuple[str, ...] = ("content", "width", "height")) -> DataFrame:
    """(key, image and layout statistics); images that ``decode`` of the columns can't read are left out.

    decode turns a row's columns into an array (height, width, 3): formats are the caller's choice.
    Pages of one shape are measured together: calls for each page would cost far more than a small page's pixels.
    """
    names = list(pages.page_columns(np.full((1, 8, 8, 3), 255, np.uint8), np.array([[8, 8]])))

    def fill(table: np.ndarray, held: list[tuple[int, np.ndarray, tuple[int, int]]]) -> None:
        alike: dict[tuple, list[tuple[int, np.ndarray, tuple[int, int]]]] = {}
        for page in held:
            alike.setdefault((page[1].shape, page[1].dtype.str), []).append(page)
        for group in alike.values():
            rows, small, sizes = zip(*group, strict=True)
            table[list(rows)] = np.column_stack([*pages.page_columns(np.stack(small), np.array(sizes)).values()])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            table = np.zeros((len(pdf), len(names)))
            read, held, pixels = [], [], 0
            for i, row in enumerate(pdf.itertuples(index=False)):
                try:
                    rgb = decode(*row[1:])
                except Exception:  # an unreadable image is no reason to lose the others
                    continue
                if rgb.ndim == 3 and rgb.size:
                    small = pages.reduced(rgb)
                    if held and pixels + small.size // 3 > PIXELS:
                        fill(table, held)
                        held, pixels = [], 0
                    read.append(i)
                    held.append((i, small, rgb.shape[:2]))
                    pixels += small.size // 3
            fill(table, held)
            out = pd.DataFrame(table[read], columns=names)
            out.insert(0, "key", pdf.iloc[read, 0].array)
            yield out

    kind = df.schema[key].dataType.simpleString()
    own = df.select(df[key].alias("key"), *(df[c].alias(f"c{i}") for i, c in enumerate(columns)))
    # Names of statistics and of the key may be equal: the statistics keep theirs.
    return own.mapInPandas(run, f"key {kind}, " + ", ".join(f"{n} double" for n in names)).withColumnRenamed("key", key if key not in names else f"{key}_key")
