"""``python -m colloquy SETTINGS MODELS``: a run with the settings of a YAML or JSON file; the exit code is 1 if any item failed.

MODELS is module:function; the function gets the settings and returns the two stages, the second perhaps a ``recognise.Chunked``.
"""

from __future__ import annotations

import importlib
import json
import sys

from pyspark.sql import SparkSession

from colloquy.config import Config
from colloquy.plans import run as flow


def main(args: list[str]) -> int:
    if len(args) != 2 or ":" not in args[1]:
        print(__doc__, file=sys.stderr)
        return 2
    settings = Config.load(args[0])
    module, _, function = args[1].partition(":")
    diarize, recognise = getattr(importlib.import_module(module), function)(settings)
    spark = SparkSession.builder.getOrCreate()
    told = flow.run(spark, settings, diarize, recognise, tell=lambda step, counts: print(step, json.dumps(counts, sort_keys=True), file=sys.stderr))
    print(json.dumps({**told.asDict(), "journal": f"{settings.out_dir}/journal"}, ensure_ascii=False, indent=2))
    return told.exit_code


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
