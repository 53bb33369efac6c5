"""Derived tables kept fresh: declared inputs, full or incremental refresh, run log."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import (
    batch_ids,
    batch_stamps,
    current_version,
    drop_folder,
    read_batches,
    read_current,
    same_key,
    without_keys,
    write_batch,
    write_version,
)

FULL, APPEND, TOUCHED = "full", "append", "touched"
LOG_SCHEMA = (
    "run_id bigint, node string, state string, mode string, input_versions string, "
    "started_at double, seconds double, message string, epoch string"
)


@dataclass(frozen=True)
class Node:
    """A derived table.

    full     recompute everything, write a new version
    append   a per-row result: each batch of the first input has a batch of the result under the same id; batches that
             are new, late or written again are computed, those that are gone are removed
    touched  an aggregate keyed by `key`: recompute only key values (null is one) that occur in new or changed batches
             of the first input, or occurred in what they replace; the new version holds these and the other rows of
             the last one. `touch` adds the key to input rows.

    What a node has consumed is a manifest of its inputs, for batches the ids and commit stamps, so any id in any order
    and any rewrite is seen. A change of another input, or of an input as a whole, means a full computation: an append
    node then begins a new epoch of batches, a touched one writes a full version.
    """

    name: str
    inputs: tuple[str, ...]
    fn: Callable[..., DataFrame]
    mode: str = FULL
    key: str | None = None
    touch: Callable[[DataFrame], DataFrame] | None = None


@dataclass
class Graph:
    spark: SparkSession
    root: str
    nodes: dict[str, Node] = field(default_factory=dict)
    bases: dict[str, str] = field(default_factory=dict)

    def base(self, name: str, path: str) -> None:
        """A table of appended batches."""
        self.bases[name] = path

    def node(self, name: str, inputs: Sequence[str], fn: Callable[..., DataFrame], mode: str = FULL,
             key: str | None = None, touch: Callable[[DataFrame], DataFrame] | None = None) -> None:
        if mode == TOUCHED and not (key and touch):
            raise ValueError("touched refresh needs a key and a touch function")
        self.nodes[name] = Node(name, tuple(inputs), fn, mode, key, touch)

    def path(self, name: str) -> str:
        return self.bases.get(name) or f"{self.root}/tables/{name}"

    def order(self, target: str) -> list[str]:
        """Nodes the target needs, inputs first."""
        seen: list[str] = []

        def visit(name: str, trail: tuple[str, ...]) -> None:
            if name in trail:
                raise ValueError(f"cycle through {name}")
            if name in self.nodes and name not in seen:
                for i in self.nodes[name].inputs:
                    visit(i, (*trail, name))
                seen.append(name)

        visit(target, ())
        return seen

    def _batches(self, name: str, state: dict[str, dict] | None = None) -> str | None:
        """Folder of batches of a base table or of an append node's present epoch."""
        if name in self.bases:
            return self.path(name)
        epoch = (self._state() if state is None else state).get(name, {}).get("epoch")
        return f"{self.path(name)}/{epoch}" if epoch else None

    def read(self, name: str, state: dict[str, dict] | None = None) -> DataFrame:
        if name in self.bases or self.nodes[name].mode == APPEND:
            folder = self._batches(name, state)
            if folder is None:
                raise FileNotFoundError(f"{name} has not been computed")
            return read_batches(self.spark, folder)
        return read_current(self.spark, self.path(name))

    def manifest(self, name: str, state: dict[str, dict]) -> dict:
        """What the table holds now: its batches with their commit stamps, or its version."""
        if name in self.bases or self.nodes[name].mode == APPEND:
            folder = self._batches(name, state)
            stamps = batch_stamps(self.spark, folder) if folder else {}
            return {"epoch": state.get(name, {}).get("epoch"), "batches": {str(k): v for k, v in stamps.items()}}
        return {"version": current_version(self.spark, self.path(name))}

    def log(self) -> DataFrame:
        path = f"{self.root}/_runs"
        if not batch_ids(self.spark, path):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return read_batches(self.spark, path).drop("_batch_id")

    def _state(self) -> dict[str, dict]:
        """Last input versions and run count per node: one row per node of the graph."""
        done = self.log().where(F.col("state") == "SUCCEEDED")
        rows = done.groupBy("node").agg(
            F.max_by("input_versions", "run_id").alias("inputs"),
            F.max_by("epoch", "run_id").alias("epoch"),
            F.max(F.col("started_at") + F.col("seconds")).alias("done_at"),
        )
        return {r["node"]: r.asDict() for r in rows.collect()}

    def refresh(self, target: str, max_age: float | None = None) -> list[tuple[str, str]]:
        """Bring the target up to date; nodes whose inputs did not change are skipped.

        With `max_age` (seconds) nothing is looked at while every node was last computed within that time.
        """
        state = self._state()
        order = self.order(target)
        oldest = min((state.get(n, {}).get("done_at") or 0.0 for n in order), default=0.0)
        if max_age is not None and time.time() - oldest <= max_age:
            return [(n, "FRESH") for n in order]
        run_id = max(batch_ids(self.spark, f"{self.root}/_runs"), default=0) + 1
        entries, outcome, error = [], [], None
        for name in order:
            node = self.nodes[name]
            manifests = {i: self.manifest(i, state) for i in node.inputs}
            text = json.dumps(manifests, sort_keys=True)
            last = state.get(name, {})
            start, message, epoch = time.time(), None, last.get("epoch")
            if last.get("inputs") == text:
                result = "SKIPPED"
            else:
                try:
                    epoch = self._run(node, last, manifests, state)
                    result = "SUCCEEDED"
                    state[name] = {"inputs": text, "epoch": epoch}
                except Exception as e:  # noqa: BLE001 - logged, then raised
                    result, message, error = "FAILED", str(e), e
            entries.append((run_id, name, result, node.mode, text, start, time.time() - start, message, epoch))
            outcome.append((name, result))
            if result == "FAILED":
                break
        write_batch(self.spark.createDataFrame(entries, LOG_SCHEMA), f"{self.root}/_runs", run_id)
        if error is not None:
            raise RuntimeError(f"refresh of {outcome[-1][0]} failed: {error}") from error
        return outcome

    def _run(self, node: Node, last: dict, manifests: dict[str, dict], state: dict[str, dict]) -> str | None:
        """Computes a node; returns the epoch its batches are in."""
        path = self.path(node.name)
        if node.mode == FULL:
            write_version(node.fn(*[self.read(i, state) for i in node.inputs]), path)
            return None
        first, others = node.inputs[0], [self.read(i, state) for i in node.inputs[1:]]
        before = json.loads(last.get("inputs") or "{}")
        had, has = before.get(first, {}), manifests[first]
        whole = not before or had.get("epoch") != has["epoch"] or any(before.get(i) != manifests[i] for i in node.inputs[1:])
        folder = self._batches(first, state)
        now, then = has["batches"], {} if whole else had["batches"]
        changed = sorted(int(b) for b, stamp in now.items() if then.get(b) != stamp)
        gone = sorted(int(b) for b in then.keys() - now.keys())
        if node.mode == APPEND:
            # A new epoch has a name of its own, so what a failed attempt has left is never read.
            epoch = f"epoch-{uuid.uuid4().hex}" if whole else last["epoch"]
            for batch in changed:
                rows = read_batches(self.spark, folder, [batch])
                write_batch(node.fn(rows, *others).drop("_batch_id"), f"{path}/{epoch}", batch)
            for batch in gone:
                drop_folder(self.spark, f"{path}/{epoch}/_batch_id={batch}")
            return epoch
        rows = read_batches(self.spark, folder)
        if whole:
            write_version(node.fn(rows, *others), path)
            for old in batch_ids(self.spark, f"{path}/keys"):
                if str(old) not in now:
                    drop_folder(self.spark, f"{path}/keys/_batch_id={old}")
        else:
            # Keys in the changed batches now, and keys that were in them when they were last read.
            kept = [b for b in batch_ids(self.spark, f"{path}/keys") if b in {*changed, *gone}]
            parts = [self._keys(node, folder, changed)] if changed else []
            parts += [read_batches(self.spark, f"{path}/keys", kept).select(node.key)] if kept else []
            keys = reduce(DataFrame.union, parts).distinct()
            tagged = node.touch(rows).alias("r")
            touched = tagged.join(keys.alias("k"), same_key("r", "k", [node.key]), "left_semi").select(*rows.columns)
            rest = without_keys(read_current(self.spark, path), keys, [node.key])
            write_version(rest.unionByName(node.fn(touched, *others)), path)
        # Only now, when the table follows the batches: a refresh that died before is done again with the old keys.
        for batch in changed:
            write_batch(self._keys(node, folder, [batch]).coalesce(1), f"{path}/keys", batch)
        for batch in gone:
            drop_folder(self.spark, f"{path}/keys/_batch_id={batch}")
        return None

    def _keys(self, node: Node, folder: str, batches: list[int]) -> DataFrame:
        """The key values that occur in some batches."""
        return node.touch(read_batches(self.spark, folder, batches)).select(node.key).distinct()


def run_report(log: DataFrame, n: int = 30) -> DataFrame:
    """Latest runs first, with their duration."""
    return log.orderBy(F.desc("run_id"), F.desc("started_at"), "node").limit(n)
