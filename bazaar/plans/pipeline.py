"""Stage runner (IO14) and the fail-soft report runner (Q21).

Stages communicate through storage, as in the source: ``clean`` writes the
clean Parquet and the report, ``eda`` and ``db`` read it back.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from bazaar.operators import clean as C
from bazaar.operators import dims as D
from bazaar.operators.report_states import ReportStates
from bazaar.operators.reports import EDA_QUESTIONS, NOT_ADDITIVE
from bazaar.schema import RAW_FILE_GLOB
from bazaar.sources import files as IO
from bazaar.sources.scratch import owned

log = logging.getLogger("bazaar")
STAGES = ["clean", "eda", "db"]


def run_all(df: DataFrame, sink: Callable[[str, DataFrame], None] | None = None,
            questions: dict | None = None, parallel: int = 1,
            states: ReportStates | None = None) -> dict[str, DataFrame | Exception]:
    """Q21: build (and, with ``sink``, materialise) every table of the EDA questions; a
    failing question is logged and recorded, the others still run. With ``states`` the
    additive ones are answered from them, so that together they need the fact once.

    ``parallel > 1`` submits that many questions at once from driver
    threads (Spark schedules jobs from several threads side by side), so the
    short final stages of one report overlap the scans of the next instead
    of leaving executors idle. Results keep the questions' order."""
    items = list((questions or EDA_QUESTIONS).items())

    def one(name: str, fn) -> DataFrame | Exception:
        try:
            res = fn(df if states is None or name in NOT_ADDITIVE else states)
            if sink is not None:
                sink(name, res)
            return res
        except Exception as exc:  # noqa: BLE001 - keep the suite resilient
            log.warning("question %s failed: %s", name, exc)
            return exc

    if parallel <= 1:
        return {name: one(name, fn) for name, fn in items}
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        futures = [(name, pool.submit(copy_context().run, one, name, fn)) for name, fn in items]
        return {name: f.result() for name, f in futures}


def run(spark: SparkSession, raw_dir: str, out_dir: str, stages: list[str] | None = None,
        window: tuple[str, str] | None = None, database: str | None = None,
        parallel: int = 4, multi_line: bool = False, pattern: str = RAW_FILE_GLOB) -> dict[str, object]:
    """Run the named stages in the order given (default: all); the EDA
    questions run ``parallel`` at a time. ``eda`` and ``db`` compute the clean fact
    when it is absent. Intermediates are deleted at the end; the results named
    here are read from what was written."""
    stages = stages or STAGES
    unknown = [s for s in stages if s not in STAGES]
    if unknown:
        raise ValueError(f"unknown stages {unknown}; choose from {STAGES}")
    out = out_dir.rstrip("/")
    clean_path = f"{out}/transactions_clean.parquet"
    results: dict[str, object] = {}

    def cleaned() -> C.Cleaned:
        raw = IO.read_raw(spark, raw_dir, pattern, multi_line=multi_line)
        kw = {"window": window} if window else {}
        return C.clean_pipeline(raw, order=IO.ORDER_COLUMNS, **kw)

    def load() -> DataFrame:
        return IO.load_clean(spark, clean_path, lambda: cleaned().clean.drop(*IO.ORDER_COLUMNS))

    with owned(spark):
        for stage in stages:
            if stage == "clean":
                res = cleaned()
                IO.write_clean(res.clean.drop(*IO.ORDER_COLUMNS), clean_path, f"{out}/transactions_clean.csv")
                IO.write_report(res.report, f"{out}/cleaning_report.csv")
                results["clean"] = clean_path
            elif stage == "eda":
                def sink(name: str, frame: DataFrame) -> None:
                    frame.write.mode("overwrite").parquet(f"{out}/eda/{name}")
                fact = load()
                ran = run_all(fact, sink, parallel=parallel, states=ReportStates.build(fact))
                results["eda"] = {name: res if isinstance(res, Exception) else spark.read.parquet(f"{out}/eda/{name}")
                                  for name, res in ran.items()}
            elif stage == "db":
                df = load()
                results["db"] = IO.load_warehouse(spark, df, D.build_dimensions(df), f"{out}/warehouse",
                                                  database=database)
    return results
