"""State machines as data: states, legal edges, and a guard. Transitions are also a DataFrame, for audits."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


class IllegalTransition(ValueError):
    """A state was to follow another that it may not follow, or isn't one of the machine's."""


@dataclass(frozen=True)
class Machine:
    name: str
    initial: str
    edges: frozenset[tuple[str, str]]
    terminal: frozenset[str] = field(default_factory=frozenset)

    @property
    def states(self) -> frozenset[str]:
        return frozenset(s for e in self.edges for s in e) | {self.initial}

    def to(self, before: str, after: str) -> str:
        if before not in self.states or after not in self.states:
            raise IllegalTransition(f"{self.name}: {before!r} or {after!r} is no state")
        if (before, after) not in self.edges:
            raise IllegalTransition(f"{self.name}: {before} -> {after}")
        return after

    def reachable(self) -> frozenset[str]:
        found, new = {self.initial}, {self.initial}
        while new:
            new = {b for a, b in self.edges if a in new} - found
            found |= new
        return frozenset(found)


def machine(name: str, initial: str, terminal: str, edges: str) -> Machine:
    """Edges in lines "from: to to to"; an asterisk stands for the state itself."""
    pairs = set()
    for line in edges.strip().splitlines():
        before, _, after = line.partition(":")
        pairs |= {(before.strip(), before.strip() if a == "*" else a) for a in after.split()}
    return Machine(name, initial, frozenset(pairs), frozenset(terminal.split()))


#: The states and legal edges of each machine.
MACHINES = {
    m.name: m
    for m in (
        machine("table_lifecycle", "absent", "complete absent", """
            absent: none in_progress awaiting_snapshot
            none: in_progress awaiting_snapshot absent *
            in_progress: complete awaiting_snapshot none absent
            complete: in_progress awaiting_snapshot none absent *
            awaiting_snapshot: in_progress complete none absent *"""),
        machine("run_phase", "starting", "stopped failed", """
            starting: recovering reconciling stopping failed
            reconciling: recovering snapshotting streaming stopping failed
            recovering: reconciling stopping failed
            snapshotting: streaming stopping failed
            streaming: snapshotting draining stopping failed
            draining: stopping failed
            stopping: stopped failed *"""),
        machine("snapshot_completion", "awaiting_callbacks", "callbacks_complete not_required streaming", """
            awaiting_callbacks: callbacks_started
            callbacks_started: completion_notified callbacks_complete *
            completion_notified: callbacks_complete *
            not_required: streaming *
            callbacks_complete: streaming"""),
        machine("runtime_root_lifecycle", "absent", "", """
            absent: provisioning
            provisioning: active absent
            active: quarantining *
            quarantining: completion_recorded *
            completion_recorded: deleted_recorded *
            deleted_recorded: absent"""),
        machine("acquisition_recovery", "absent", "absent", """
            absent: requested
            requested: offsets_file_deleted *
            offsets_file_deleted: resume_point_deleted requested
            resume_point_deleted: armed requested
            armed: requested absent"""),
        machine("interruption_marker", "absent", "consumed", """
            absent: armed
            armed: consumed
            consumed: absent"""),
        machine("destination_ownership", "available", "callback_owned", """
            available: attached
            attached: active available
            active: available callback_owned"""),
        machine("catalog_change", "observed", "applied superseded", """
            observed: unconfirmed pending superseded
            unconfirmed: pending superseded *
            pending: marked due deferred refused superseded
            marked: due deferred refused superseded *
            deferred: marked due refused superseded *
            refused: marked due deferred superseded *
            due: deferred refused superseded applied
            superseded: applied"""),
        machine("publication_admission", "absent", "", """
            absent: pending
            pending: error admitted external refused *
            admitted: error refused external pending *
            error: pending admitted external refused *
            external: pending error refused *
            refused: pending external *"""),
        machine("catalog_schema_liveness", "unavailable", "", """
            visible: empty unavailable error *
            empty: visible unavailable error *
            unavailable: visible empty error *
            error: visible empty unavailable *"""),
        machine("schema_refusal", "absent", "resolved", """
            absent: pending
            pending: resolved *
            resolved: pending *"""),
        machine("catalog_baseline", "absent", "", """
            absent: stale invalidated
            valid: stale absent
            stale: invalidated valid absent *
            invalidated: stale valid absent *"""),
    )
}

#: Why a run stopped, symptoms before causes; of several outcomes the last in this order is reported.
RUN_OUTCOMES = ("max_seconds", "idle", "work_done", "engine_finished", "hung", "catalog_unresolved", "recovery_uncleared", "source_dark", "engine_error", "error")


def outcome(*seen: str) -> str:
    return max(seen, key=RUN_OUTCOMES.index)


def transitions(spark: SparkSession) -> DataFrame:
    """machine, before, after of every legal edge."""
    return spark.createDataFrame(sorted((m.name, a, b) for m in MACHINES.values() for a, b in m.edges), "machine string, before string, after string")
