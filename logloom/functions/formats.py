"""Declarative log formats and template-mining settings.

A log family is data, not code: a header regex with one group per field, the regex that finds
the entity inside the content, the masks, and the output column order.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Mask:
    """Replace every match of ``pattern`` by ``token``."""

    pattern: str
    token: str


@dataclass(frozen=True)
class LogFormat:
    """How the lines of one log family are read.

    ``header`` is anchored at both ends and has one capture group per name in ``fields``; the
    last field is the message content. ``entity`` has one capture group and is searched in the
    content. Patterns use ASCII classes, no look-around and no back-reference.
    """

    name: str
    header: str
    fields: tuple[str, ...]
    entity: str
    entity_col: str
    masks: tuple[Mask, ...] = ()

    def __post_init__(self) -> None:
        if self.fields[-1] != "Content":
            raise ValueError("the last header field must be Content")

    @property
    def columns(self) -> tuple[str, ...]:
        """Column order of the structured event table."""
        return ("LineId", *self.fields, self.entity_col, "EventId", "EventTemplate")


@dataclass(frozen=True)
class MiningConfig:
    """Settings of template mining.

    ``sim_th``: least share of equal tokens for a line to join a template; ``depth``: tree depth,
    so ``depth - 3`` leading tokens belong to the leaf key; ``max_children``: tokens a tree node
    keeps, the wildcard included; ``batch``: signatures of a leaf that are settled in one row (speed only).
    """

    sim_th: float = 0.4
    depth: int = 4
    max_children: int = 100
    batch: int = 64

    def __post_init__(self) -> None:
        if not 0.0 <= self.sim_th <= 1.0:
            raise ValueError("sim_th must lie in [0, 1]")
        if self.depth < 3 or self.max_children < 2 or not 1 <= self.batch <= 1000:
            raise ValueError("depth >= 3, max_children >= 2 and 1 <= batch <= 1000 are required")

    @property
    def head_tokens(self) -> int:
        return self.depth - 3


# Masks, header patterns and entity patterns of the two log families.
MASKS = (
    Mask(r"(blk_-?\d+)", "<BLOCK>"),
    Mask(r"(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})", "<IP>"),
    Mask(r"(:?\d+)", "<NUM>"),
)

BLOCK_LOG = LogFormat(
    name="block",
    header=r"^(\d{6})\s+(\d{6})\s+(\d+)\s+(\w+)\s+([\w.$]+):\s+(.+)$",
    fields=("Date", "Time", "Pid", "Level", "Component", "Content"),
    entity=r"(blk_-?\d+)",
    entity_col="BlockId",
    masks=MASKS,
)

VM_LOG = LogFormat(
    name="vm",
    header=(
        r"^([\w\-\.]+)\s+(\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}\.\d+)\s+(\d+)\s+(\w+)\s+"
        r"([\w\.]+)\s+(\[.*?\])?\s*(.*)$"
    ),
    fields=("Filename", "Timestamp", "Pid", "Level", "Component", "RequestId", "Content"),
    entity=r"\[instance:\s+([\w\-]+)\]",
    entity_col="InstanceId",
    masks=MASKS,
)

FORMATS = {fmt.name: fmt for fmt in (BLOCK_LOG, VM_LOG)}
