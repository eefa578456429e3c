"""gustolake — restaurant-order analytics on Spark.

Layers:
    sources/    readers and writers, table contracts, test-data mapping
    functions/  Column expressions (cleaning, labels)
    operators/  DataFrame -> DataFrame building blocks (clean, base, metrics,
                ranking/quantiles, serving, quality)
    plans/      composed jobs: bronze, silver, gold, full pipeline run

Public functions return lazy DataFrames unless their docstring says that they
trigger a job (writes, stages, exact quantiles and ranks do); each takes an explicit ``as_of`` date where the
result depends on "today".
"""

from gustolake.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
