"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigilo.session import settings, stored  # noqa: F401  (for the modules of this subpackage)

#: One run of the six ASCII white-space characters.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def normalised(text: str | Column) -> Column:
    """Text with every white-space run replaced by one space; null is empty."""
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(col, F.lit("")), SPACES, " ")


def uniform_hash(*cols: Column | str | int) -> Column:
    """A long that depends on the values only (never on the partition)."""
    return F.xxhash64(*[F.lit(c) if isinstance(c, int) else c for c in cols])


_SHIPPED: set[str] = set()


def ship(df: DataFrame) -> DataFrame:
    """Send this package to the Python workers, unless their path has it
    (PYTHONPATH, or the package came as a --py-files archive)."""
    sc = df.sparkSession.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if sc.applicationId not in _SHIPPED and os.path.isdir(root) and root not in paths:
        archive = os.path.join(tempfile.mkdtemp(prefix="vigilo-code-"), "vigilo_code.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(os.path.join(root, "vigilo")):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, root))
        sc.addPyFile(archive)  # the driver serves it to every executor, also to later ones
        _SHIPPED.add(sc.applicationId)
    return df
