"""What a change stream may be configured to, checked before anything runs."""

from __future__ import annotations

#: Options that must stay as they are for nothing to be acknowledged before it is durable.
PINNED = {"lsn.flush.mode": "connector", "provide.transaction.metadata": "true", "offset.flush.interval.ms": "0"}

#: What a TRUNCATE or DROP of the source does to the destination.
POLICIES = ("replicate", "log", "ignore")


class UnsafeOption(ValueError):
    """An option would break the order of durability."""


def checked(overrides: dict[str, str]) -> dict[str, str]:
    """overrides, unless one changes a pinned option."""
    wrong = {k: v for k, v in overrides.items() if k in PINNED and str(v).lower() != PINNED[k]}
    if wrong:
        raise UnsafeOption(f"pinned options can't be changed: {sorted(wrong)}")
    return PINNED | overrides


def internal_topics(prefix: str) -> set[str]:
    return {f"{prefix}.transaction", f"__debezium-heartbeat.{prefix}", f"{prefix}.snapshot"}


def no_collision(prefix: str, tables: list[str]) -> None:
    """No captured table may publish on a topic that the stream uses for itself."""
    clash = sorted(t for t in tables if f"{prefix}.{t}" in internal_topics(prefix))
    if clash:
        raise UnsafeOption(f"tables would publish on internal topics: {clash}")


def policy(mode: str) -> str:
    if mode not in POLICIES:
        raise UnsafeOption(f"{mode!r} is none of {POLICIES}")
    return mode
