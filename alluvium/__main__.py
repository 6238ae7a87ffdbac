"""Command line: python -m alluvium (--config file.yaml | --source name) [--stage extract|transform|load]."""

from __future__ import annotations

import argparse
import logging
import sys

from .config import load, store_path
from .errors import ConfigError, PipelineError
from .sources.sites import site_config


def main(argv: list[str] | None = None) -> int:
    """0 when all went well, 1 when a stage failed, 2 when the configuration or an argument is wrong."""
    parser = argparse.ArgumentParser(prog="alluvium")
    which = parser.add_mutually_exclusive_group(required=True)
    which.add_argument("--config", help="YAML file of a source")
    which.add_argument("--source", help="a known source, with the settings of its site")
    parser.add_argument("--stage", help="run this stage only")
    args = parser.parse_args(argv)
    logging.basicConfig()
    log = logging.getLogger("alluvium")
    try:
        config = load(args.config) if args.config else site_config(args.source, store_path())
        logging.getLogger().setLevel(config.log_level)
    except (ConfigError, ValueError) as e:
        log.error("%s", e)
        return 2
    from pyspark.sql import SparkSession

    from .plans import pipeline

    spark = SparkSession.builder.appName(config.name).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        pipeline.run(pipeline.stages(spark, config), args.stage)
    except (ConfigError, ValueError) as e:
        log.error("%s", e)
        return 2
    except PipelineError as e:
        log.exception("failed: %s", e)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
