"""A Spark-native engine for change-data-capture data."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path
from typing import TYPE_CHECKING

if TYPE_CHECKING:
    from pyspark.sql import SparkSession

__version__ = "0.1.0"


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python this package, once for each application: they need not have it installed."""
    context, home = spark.sparkContext, Path(__file__).parent
    if getattr(context, "_changeloom_shipped", False) or not home.is_dir():
        return
    target = Path(tempfile.mkdtemp(prefix="changeloom-")) / f"changeloom-{__version__}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(home.rglob("*.py")):
            z.write(f, Path("changeloom") / f.relative_to(home))
    context.addPyFile(str(target))
    context._changeloom_shipped = True
