"""Field specs and table contracts.

A ``Field`` says how one JSON field becomes one typed column; a ``Contract``
says what a keyed table promises (key, not-null columns, defaults, maximum
text lengths, load-time column). Both are plain data: every operator turns
them into Spark column expressions, nothing here touches rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

# JSON field kinds understood by ``recordtable.functions.json_rules``.
KINDS = ("int", "long", "double", "text", "list")

_KIND_DEFAULTS = {"int": 0, "long": 0, "double": 0.0, "text": "", "list": None}


@dataclass(frozen=True)
class Field:
    """One JSON field read into one column.

    ``name`` is the JSON key, ``column`` the output column (defaults to the
    key), ``kind`` the coercion rule and ``default`` the value used when the
    field is absent, null or not coercible.  ``default=None`` keeps NULL.
    """

    name: str
    kind: str = "text"
    column: str | None = None
    default: Any = "__kind__"

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown field kind {self.kind!r}; expected one of {KINDS}")
        if self.default == "__kind__":
            object.__setattr__(self, "default", _KIND_DEFAULTS[self.kind])

    @property
    def out(self) -> str:
        return self.column or self.name


@dataclass(frozen=True)
class Contract:
    """What a keyed table promises.

    ``key`` is the business key (unique, not null); ``not_null`` lists other
    required columns; ``not_empty`` lists text columns reported when empty
    or NULL; ``defaults`` maps a column to the value that fills a NULL;
    ``max_len`` maps a text column to its maximum length; ``load_ts`` names
    the column stamped with the load time (or None).
    """

    key: str
    not_null: tuple[str, ...] = ()
    not_empty: tuple[str, ...] = ()
    defaults: dict[str, Any] = field(default_factory=dict)
    max_len: dict[str, int] = field(default_factory=dict)
    load_ts: str | None = None


# ---------------------------------------------------------------------------
# The record table of the original tool (its JSON field names,
# its column names, its defaults and its column lengths). They must stay as
# they are for documents of that shape to load into the same table.
# ---------------------------------------------------------------------------
HERO_FIELDS = (
    Field("id", "int", "hero_id", default=None),
    Field("localized_name", "text", "hero_name"),
    Field("base_health", "int"),
    Field("base_mana", "int"),
    Field("base_attack_min", "int"),
    Field("base_attack_max", "int"),
    Field("move_speed", "int"),
    Field("primary_attr", "text", "primary_attribute"),
    Field("roles", "list"),
)

HERO_CONTRACT = Contract(
    key="hero_id",
    not_null=("hero_id",),
    not_empty=("hero_name",),
    defaults={
        "base_health": 0,
        "base_mana": 0,
        "base_attack_min": 0,
        "base_attack_max": 0,
        "move_speed": 0,
    },
    max_len={"hero_name": 100, "primary_attribute": 20, "roles": 200},
    load_ts="processed_date",
)
