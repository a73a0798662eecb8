"""``python -m transitlake CONFIG.toml [--log-level LEVEL]``: runs a lake until interrupted."""

from __future__ import annotations

import argparse
import logging

from .plans.lake import run_pipeline_from_toml


def main(argv: list[str] | None = None) -> int:
    """0 if it ran; 1, with a line that begins ``Error:``, if it could not."""
    parser = argparse.ArgumentParser(prog="transitlake", description="Fetch transit feeds into a lake and compact it.")
    parser.add_argument("toml_path", help="the TOML configuration")
    parser.add_argument("--log-level", default="INFO", help="logging level (default: INFO)")
    args = parser.parse_args(argv)
    try:
        logging.basicConfig(level=args.log_level.upper())
        run_pipeline_from_toml(args.toml_path)
    except Exception as e:
        print(f"Error: {e}")
        return 1
    return 0
