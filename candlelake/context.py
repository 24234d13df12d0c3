"""What a load step needs to know: table contract and batch identity."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

TABLE_TYPES = ("Stage", "Dim", "Fact")

# Technical columns never counted as business attributes.
AUDIT_COLUMNS = frozenset({
    "__ActivationDateTime", "__BusinessKeyHash", "__CreateDateTime", "__CreatedBatchLogId",
    "__CurrentFlag", "__DeactivationDateTime", "__DeletedFlag", "__EffectiveEndDateTime",
    "__EffectiveStartDateTime", "__FactKeyHash", "__Hash1Type", "__Hash2Type", "__HashKey",
    "__HashValue", "__LastModified", "__UpdateDateTime", "__UpdatedBatchLogId", "__lastmodified",
})

NULL_TOKEN = "~null~"


def _names(csv: str) -> tuple[str, ...]:
    return tuple(part.strip() for part in csv.split(",") if part.strip())


@dataclass(frozen=True)
class TableSpec:
    """Key and change-tracking columns of one versioned table.

    ``strict`` reproduces the original load rules to the letter, including the
    ones that lose data; the default is the corrected form of each.
    """

    table_type: str
    business_columns: tuple[str, ...]
    type1_columns: tuple[str, ...] = ()
    strict: bool = False

    def __post_init__(self) -> None:
        if self.table_type not in TABLE_TYPES:
            raise ValueError(f"tableType {self.table_type!r} is not one of {list(TABLE_TYPES)}")

    @classmethod
    def from_params(cls, params: dict[str, str], strict: bool = False) -> TableSpec:
        """Build from ``{businessColumns, typeIColumns, tableType}`` with CSV column lists."""
        required = ("businessColumns", "typeIColumns", "tableType")
        missing = [name for name in required if name not in params]
        if missing:
            raise ValueError(f"parameters lack {', '.join(missing)}")
        return cls(params["tableType"], _names(params["businessColumns"]),
                   _names(params["typeIColumns"]), strict)

    @property
    def null_token(self) -> str | None:
        return None if self.strict else NULL_TOKEN

    @property
    def key_hash(self) -> str:
        return {"Stage": "__HashKey", "Dim": "__BusinessKeyHash", "Fact": "__FactKeyHash"}[self.table_type]

    @property
    def value_hash(self) -> str:
        return {"Stage": "__HashValue", "Dim": "__Hash2Type", "Fact": "__FactSCD1Hash"}[self.table_type]


@dataclass(frozen=True)
class BatchContext:
    """Identity and clock of one load; passing it in keeps loads repeatable."""

    batch_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    effective_ts: datetime = field(
        default_factory=lambda: datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0))

    @property
    def start(self) -> str:
        return self.effective_ts.strftime("%Y-%m-%d %H:%M:%S")

    @property
    def end(self) -> str:
        """Closing stamp of the versions this batch replaces: one second before it starts."""
        return (self.effective_ts - timedelta(seconds=1)).strftime("%Y-%m-%d %H:%M:%S")


SILVER_SPEC = TableSpec("Stage", ("Symbol", "ExchangeName", "Currency", "Date"))
DIM_SYMBOL_SPEC = TableSpec("Dim", ("Symbol", "ExchangeName", "Currency"))
FACT_DAILY_SPEC = TableSpec("Fact", ("SymbolSID", "DateID"), ("Volume", "High", "Low", "Close", "Open"))
