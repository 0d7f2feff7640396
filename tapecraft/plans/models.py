"""The star schema as versioned models, rebuilt in dependency order where inputs changed.

A model's version names the versions of its inputs. ``build_models`` makes a model
anew only if one of them has a newer version, from these very versions, and
switches it in whole; so a reader that takes one version of each model never sees
a half-written one, and a run that stops goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tapecraft.operators.regime import ofi_return_by_regime
from tapecraft.plans import gold as G
from tapecraft.sources.versioned import VersionedTable


@dataclass(frozen=True)
class Model:
    """``make`` gets a frame for each of ``inputs``: sources or models before this one."""

    name: str
    inputs: tuple[str, ...]
    make: Callable[..., DataFrame]


#: From the silver tables (batch and speed layer) and the metadata feed.
GOLD_MODELS = (
    Model("stg_trades_minute", ("silver",), G.stg_trades_minute),
    Model("stg_trades_minute_stream", ("silver_stream",), G.stg_trades_minute_stream),
    Model("fct_market_window", ("stg_trades_minute",), G.fct_market_window),
    Model("fct_market_window_stream", ("stg_trades_minute_stream",), G.fct_market_window_stream),
    Model("dim_time", ("stg_trades_minute", "stg_trades_minute_stream"), G.dim_time),
    Model("dim_asset", ("fct_market_window", "metadata", "fct_market_window_stream"),
          lambda fact, meta, stream: G.dim_asset(fact, meta, with_loaded_at=False, stream_fact=stream)),
    Model("fct_ofi_return_by_regime", ("fct_market_window",), ofi_return_by_regime),
)


def build_models(spark: SparkSession, root: str, sources: dict[str, VersionedTable],
                 models: tuple[Model, ...] = GOLD_MODELS) -> list[str]:
    """Bring the models under ``root`` up to date with the sources; the names of those rebuilt."""
    tables, rebuilt = dict(sources), []
    for model in models:
        missing = [name for name in model.inputs if name not in tables]
        if missing:
            raise ValueError(f"{model.name} needs {', '.join(missing)} before it")
        table = tables[model.name] = G.model_table(spark, root, model.name)
        pinned = {name: tables[name].version() for name in model.inputs}
        empty = [name for name, version in pinned.items() if version is None]
        if empty:
            raise ValueError(f"{model.name} needs {', '.join(empty)}, which have no version yet")
        inputs = {name: version.number for name, version in pinned.items()}
        current = table.version()
        if current is None or current.inputs != inputs:
            table.replace(model.make(*[tables[name].read(version=pinned[name]) for name in model.inputs]), inputs=inputs)
            rebuilt.append(model.name)
    return rebuilt


def read_models(spark: SparkSession, root: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The current version of each model."""
    return {name: G.model_table(spark, root, name).read() for name in names or [m.name for m in GOLD_MODELS]}
