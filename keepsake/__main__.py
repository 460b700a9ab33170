"""Run one study on a file: ``spark-submit ... -m keepsake churn_forest INPUT OUTPUT``.

Writes the metrics, the per-class report, the scored listing, the held-out rows as CSV, the counts of
missing cells and the fitted model below OUTPUT, and prints the listing's first rows.

``... -m keepsake score MODEL INPUT OUTPUT`` scores a new file with a model that a study has written
(its OUTPUT/model), and writes the listing. Nothing is fitted, and the file needs no label.
"""

from __future__ import annotations

import argparse
import sys

from keepsake.operators import evaluate as ev
from keepsake.operators.split import DEFAULT_SEED
from keepsake.plans.scoring import Scorer, save_model
from keepsake.plans.studies import FILLS, STUDIES, run_study
from keepsake.session import build_session
from keepsake.sources.sinks import preview, write_csv


def main(arguments: list[str] | None = None) -> None:
    arguments = sys.argv[1:] if arguments is None else arguments
    if arguments[:1] == ["score"]:
        score(arguments[1:])
    else:
        study(arguments)


def score(arguments: list[str]) -> None:
    parser = argparse.ArgumentParser(prog="keepsake score", description=__doc__.split("\n\n")[2])
    parser.add_argument("model", help="folder of a model that a study has written")
    parser.add_argument("input", help="file or folder with the columns of the study's files")
    parser.add_argument("output", help="folder for the listing; must not exist")
    parser.add_argument("--key", nargs="*", help="columns that identify a row; default all")
    chosen = parser.parse_args(arguments)

    spark = build_session("keepsake-score")
    scorer = Scorer.load(spark, chosen.model)
    rows = scorer.read(spark, chosen.input)
    key = chosen.key or [c for c in rows.columns if c != "label"]
    scorer.listing(rows, key).write.parquet(f"{chosen.output}/listing")
    preview(spark.read.parquet(f"{chosen.output}/listing"), key).show(truncate=False)


def study(arguments: list[str]) -> None:
    parser = argparse.ArgumentParser(prog="keepsake", description=__doc__.splitlines()[0])
    parser.add_argument("study", choices=sorted(STUDIES))
    parser.add_argument("input", help="file or folder that the study reads")
    parser.add_argument("output", help="folder for the results; must not exist")
    parser.add_argument("--key", nargs="*", help="columns that identify a row; default all")
    parser.add_argument("--seed", type=int, default=DEFAULT_SEED)
    parser.add_argument("--fill", choices=FILLS, help="for missing cells; default the study's")
    chosen = parser.parse_args(arguments)

    spark = build_session(f"keepsake-{chosen.study}")
    result = run_study(spark, chosen.study, chosen.input, chosen.key, chosen.seed, chosen.fill)
    key = chosen.key or [c for c in result.test.columns if c != "label"]
    # Rows are scored once; the metrics read what was written.
    result.listing(key).write.parquet(f"{chosen.output}/listing")
    listed = spark.read.parquet(f"{chosen.output}/listing")
    ev.evaluate(listed, score="probability").write.parquet(f"{chosen.output}/metrics")
    ev.classification_report(listed).write.parquet(f"{chosen.output}/report")
    write_csv(result.test, f"{chosen.output}/held_out", key)
    result.missing().write.parquet(f"{chosen.output}/missing")
    preview(listed, key).show(truncate=False)
    save_model(result, chosen.study, f"{chosen.output}/model")
    result.release()


if __name__ == "__main__":
    main()
