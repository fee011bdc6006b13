"""The scheduled job: train and publish, unless the source is unchanged."""

from __future__ import annotations

import dataclasses
import hashlib
import json

from shelfcast.functions.coerce import add_target, keep_existing
from shelfcast.operators.filters import trailing_weeks
from shelfcast.plans.model import TrainConfig, train
from shelfcast.sources.artifacts import read_json, write_json
from shelfcast.sources.fingerprint import FileHashes, content_fingerprint, file_signature, total_signature
from shelfcast.sources.readers import SALES_COLUMNS, coerce_sales, read_sales
from shelfcast.sources.registry import RunRegistry

# The scheduled job asks for 70 days, because the 10-week file holds 71.
SCHEDULED = TrainConfig(total_days=70)


def train_and_publish(spark, sales_path, tables, root, config=TrainConfig(), order=(),
                      signature=None, rename=None, columns=None, learner=None, daily=None):
    """Loads the sales window, trains into a new run folder and publishes the run.

    With ``daily``, a ``DailyState``, the days that it lacks are added first, and features are
    fitted from it."""
    registry = RunRegistry(spark, root)
    run_id = registry.new_run_id()
    sales = read_sales(spark, sales_path, config.weeks_window, columns, rename)
    signature = {"source": sales_path, "weeks_window": config.weeks_window, **(signature or {})}
    if daily is not None:
        daily.refresh(add_target(sales))
    metadata = train(
        sales, tables, registry.run_dir(run_id), config, order, signature, learner=learner, daily=daily
    )
    return registry.publish(run_id, metadata)


def _trained_on(spark, sales_path, config, order, rename, columns):
    """What a training reads of the source: the window's rows and the columns that it uses."""
    sales = read_sales(spark, sales_path, config.weeks_window, columns, rename)
    return keep_existing(sales, list(dict.fromkeys([*SALES_COLUMNS, *order])))


def window_fingerprint(spark, sales_path, store, config, order=(), rename=None, columns=None):
    """The content fingerprint of the training window, by way of the table of file hashes in
    ``store``: only files that are new or changed since its last use are read."""
    wanted = list(dict.fromkeys([*SALES_COLUMNS, *order]))

    def typed(raw):
        raw = raw.withColumnsRenamed(rename) if rename else raw
        raw = raw if columns is None else raw.select(*columns, "source_file")
        return keep_existing(coerce_sales(raw), [*wanted, "source_file"])

    days = FileHashes(spark, store).update(sales_path, typed)
    if config.weeks_window is not None:
        days = trailing_weeks(days, config.weeks_window)
    return total_signature(days)


def run_if_new(spark, sales_path, tables, root, config=SCHEDULED, order=(), rename=None,
               columns=None, learner=None, daily=None, incremental=True):
    """Returns the new run, or ``None`` when the sales are those of the latest run.

    An unchanged file listing settles it without reading data. Otherwise the content fingerprint
    of what training reads decides, so files that were rewritten with equal rows, or changed
    outside the window, do not cause a new training; their listing is noted beside the runs, so
    that they are not read again either. The fingerprint is added up from file hashes kept beside
    the runs, one table for each choice of columns, so that only new and changed files are read
    (``incremental=False`` reads the window; the fingerprint is the same).
    """
    last = RunRegistry(spark, root).latest()
    seen = last["metadata"].get("data_signature", {}) if last else {}
    noted = read_json(spark, f"{root}/listing.json", {}) if last else {}
    files = file_signature(spark, sales_path)
    known = [seen.get("file_signature")]
    if noted.get("run_id") == (last or {}).get("run_id"):
        known.append(noted.get("file_signature"))
    if files in known:
        return None
    if incremental:
        choice = json.dumps([sales_path, list(order), rename, columns], sort_keys=True)
        store = f"{root}/file_hashes/{hashlib.sha256(choice.encode()).hexdigest()[:16]}"
        content = window_fingerprint(spark, sales_path, store, config, order, rename, columns)
    else:
        content = content_fingerprint(_trained_on(spark, sales_path, config, order, rename, columns))
    if seen.get("fingerprint") == content:
        write_json(spark, f"{root}/listing.json", {"run_id": last["run_id"], "file_signature": files})
        return None
    signature = {"file_signature": files, "fingerprint": content}
    return train_and_publish(
        spark, sales_path, tables, root, config, order, signature, rename, columns, learner, daily
    )


def build_now(spark, sales_path, tables, root, config=TrainConfig(), **kwargs):
    """Trains and publishes in any case and writes a summary file next to the runs."""
    run = train_and_publish(spark, sales_path, tables, root, config, **kwargs)
    summary = {
        "latest": {"run_id": run["run_id"], "run_dir": run["run_dir"], "trained_at": run["trained_at"]},
        "metrics": run["metadata"],
        "config": dataclasses.asdict(config),
    }
    write_json(spark, f"{root}/build_summary.json", summary)
    return summary
