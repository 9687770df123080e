"""The rule that closes a part file."""

from __future__ import annotations

from dataclasses import dataclass

from millrace.functions.records import MAX_LINE_BYTES

# A switched-off rule is a limit no instant or byte count can reach.
OFF = 1 << 61


@dataclass(frozen=True)
class RollPolicy:
    """Close a part when it is ``max_age_s`` old, was idle for ``max_idle_s``, or holds
    more than ``max_bytes``. ``None`` switches a rule off."""

    max_age_s: float | None = 120
    max_idle_s: float | None = 30
    max_bytes: int | None = 1 << 20

    def __post_init__(self) -> None:
        for name in ("max_age_s", "max_idle_s", "max_bytes"):
            value = getattr(self, name)
            if value is not None and value <= 0:
                raise ValueError(f"{name} must be positive or None")

    @property
    def age_us(self) -> int:
        return OFF if self.max_age_s is None else round(self.max_age_s * 1_000_000)

    @property
    def idle_us(self) -> int:
        return OFF if self.max_idle_s is None else round(self.max_idle_s * 1_000_000)

    @property
    def size(self) -> int:
        return OFF if self.max_bytes is None else self.max_bytes

    def max_records(self, line_bytes: int = MAX_LINE_BYTES) -> int:
        """Records per file that keep a file within ``max_bytes``; 0 means no limit."""
        return 0 if self.max_bytes is None else max(1, self.max_bytes // line_bytes)
