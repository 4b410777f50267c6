"""Statements that define the three tables in a PostgreSQL database."""

from __future__ import annotations

from txrisk.schemas import POSITION, STORAGE, TABLES, Table

# Database types of the contracts' types, and column defaults.
TYPES = {
    "string": "TEXT",
    "bigint": "BIGINT",
    "int": "INT",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMPTZ",
    "decimal(14,2)": "NUMERIC(14,2)",
}
DEFAULTS = {"velocity_flag": "FALSE", "acknowledged": "FALSE", "ingested_at": "now()"}


def create_statement(table: Table, replay_safe: bool = True) -> str:
    """``CREATE TABLE IF NOT EXISTS`` for a contract.

    With ``replay_safe`` the table also has the message position and the batch,
    and a unique key on the position, as the replay-safe sink needs.
    """
    fields = list(table.contract)
    if replay_safe:
        extra = (*POSITION, "batch_id")
        fields += [f for f in STORAGE if f.name in extra and f.name not in table.columns]
    lines = []
    for field in fields:
        if field.name == "id":
            lines.append("id BIGSERIAL PRIMARY KEY")
            continue
        line = f'"{field.name}" {TYPES[field.dataType.simpleString()]}'
        if not field.nullable:
            line += " NOT NULL"
        if field.name in DEFAULTS:
            line += f" DEFAULT {DEFAULTS[field.name]}"
        lines.append(line)
    if replay_safe:
        lines.append(f"UNIQUE ({', '.join(POSITION)})")
    body = ",\n    ".join(lines)
    return f"CREATE TABLE IF NOT EXISTS {table.name} (\n    {body}\n)"


def create_script(replay_safe: bool = True) -> str:
    """Statements for all tables, to be run by the database's own client. The
    index on the batch lets a replay read one batch without a scan."""
    statements = [create_statement(table, replay_safe) for table in TABLES.values()]
    if replay_safe:
        statements += [
            f"CREATE INDEX IF NOT EXISTS {name}_batch ON {name} (batch_id)" for name in TABLES
        ]
    return "".join(f"{statement};\n" for statement in statements)
