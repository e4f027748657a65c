"""``spark-submit … -m dripline settings.yml job`` starts a job of a settings file and waits for it."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from dripline.config import load_config
from dripline.plans.jobs import start_job
from dripline.session import SETTINGS


def main(arguments: list[str]) -> int:
    if len(arguments) != 2:
        print("usage: python -m dripline <settings.yml> <job>", file=sys.stderr)
        return 2
    path, name = arguments
    builder = SparkSession.builder.appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    start_job(builder.getOrCreate(), load_config(path), name).awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
