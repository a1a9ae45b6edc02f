"""A stand-in for a database: tables are JSON files in a folder that all processes see, statements the few forms the library writes.

Every statement is noted in the folder.  Conditions are read as Python expressions over the row, with SQL's unknown as None.
"""

from __future__ import annotations

import datetime as dt
import fcntl
import json
import re
import uuid
from pathlib import Path


def _plain(value):
    if isinstance(value, (dt.date, dt.datetime)):
        return {"t": type(value).__name__, "v": value.isoformat()}
    return value


def _value(value):
    return getattr(dt, value["t"]).fromisoformat(value["v"]) if isinstance(value, dict) else value


class Fake:
    def __init__(self, folder):
        self.folder, self.pending = Path(folder), []

    def cursor(self):
        return Cursor(self)

    def close(self):
        self.pending = []

    def rollback(self):
        self.pending = []

    def commit(self):
        with open(self.folder / "lock", "w") as lock:
            fcntl.flock(lock, fcntl.LOCK_EX)
            if any((self.folder / "fail_commit").exists() and s.startswith("INSERT INTO target") for s, _ in self.pending):
                self.pending = []
                raise RuntimeError("commit refused")
            for change in self.pending:
                change[1]()
        self.pending = []

    def load(self, table):
        return [{k: _value(v) for k, v in row.items()} for row in json.loads((self.folder / f"{table}.json").read_text())]

    def save(self, table, rows):
        (self.folder / f"{table}.json").write_text(json.dumps([{k: _plain(v) for k, v in r.items()} for r in rows]))


def _compared(a, sign, b):
    if a is None or b is None:
        return None
    return {"=": a == b, "<": a < b, ">": a > b, "<=": a <= b, ">=": a >= b}[sign]


def _negated(a):
    return None if a is None else not a


def holds(condition, row, values):
    """Whether the condition is true for the row; AND and OR over unknown are false here where SQL has unknown, but only at the top."""
    values = iter(values)
    text = re.sub(r'"(\w+)" IN \(([?, ]+)\)', lambda m: f"(None if row[{m[1]!r}] is None else row[{m[1]!r}] in ({m[2].replace('?', 'next(values)')},))", condition)
    text = re.sub(r'"(\w+)" IS NOT NULL', r'(row["\1"] is not None)', text)
    text = re.sub(r'"(\w+)" IS NULL', r'(row["\1"] is None)', text)
    text = re.sub(r'"?(\w+)"? (=|<=|>=|<|>) \?', r'compared(row["\1"], "\2", next(values))', text)
    text = re.sub(r"NOT \((.*?)\)(?= AND|$)", r"negated(\1)", text)
    # Every mark takes its value, whatever the outcome: no short cuts.
    text = text.replace(" AND ", ") & bool(").replace(" OR ", ") | bool(")
    return bool(eval(f"bool({text})".replace("bool((", "(bool(").replace("bool(bool(", "bool("), {"row": row, "values": values, "compared": _compared, "negated": _negated, "bool": bool}))


class Cursor:
    def __init__(self, base):
        self.base, self.rows = base, []

    def close(self):
        pass

    def execute(self, statement, values=()):
        note = {"statement": statement, "values": [_plain(v) for v in values]}
        (self.base.folder / f"note-{uuid.uuid4().hex}").write_text(json.dumps(note))
        if m := re.fullmatch(r"SELECT (.*?) FROM (\w+)(?: WHERE (.*))?", statement):
            self._select(m[1], m[2], m[3], values)
        elif m := re.fullmatch(r"CREATE TABLE (\w+) AS SELECT .* WHERE 1 = 0", statement):
            self.base.pending.append((statement, lambda: self.base.save(m[1], [])))
        elif m := re.fullmatch(r"DROP TABLE (\w+)", statement):
            self.base.pending.append((statement, lambda: (self.base.folder / f"{m[1]}.json").unlink()))
        elif m := re.fullmatch(r"INSERT INTO (\w+) \((.*)\) SELECT .* FROM (\w+) WHERE load_attempt = \?", statement):
            names = [n.strip('"') for n in m[2].split(", ")]

            def move():
                moved = [{n: r[n] for n in names} for r in self.base.load(m[3]) if r["load_attempt"] == values[0]]
                self.base.save(m[1], self.base.load(m[1]) + moved)

            self.base.pending.append((statement, move))
        else:
            raise ValueError(statement)

    def executemany(self, statement, batch):
        m = re.fullmatch(r"INSERT INTO (\w+) \((.*)\) VALUES \(.*\)", statement)
        names, rows = [n.strip('"') for n in m[2].split(", ")], [tuple(r) for r in batch]
        self.base.pending.append((statement, lambda: self.base.save(m[1], self.base.load(m[1]) + [dict(zip(names, r, strict=True)) for r in rows])))

    def _select(self, columns, table, condition, values):
        rows = [r for r in self.base.load(table) if not condition or holds(condition, r, values)]
        if m := re.fullmatch(r'MIN\("(\w+)"\), MAX\("\w+"\)', columns):
            held = [r[m[1]] for r in rows if r[m[1]] is not None]
            self.rows = [(min(held, default=None), max(held, default=None))]
        else:
            self.rows = [tuple(r[c.strip('"')] for c in columns.split(", ")) for r in rows]

    def fetchone(self):
        return self.rows.pop(0) if self.rows else None

    def fetchmany(self, n):
        taken, self.rows = self.rows[:n], self.rows[n:]
        return taken


def connect(folder):
    return Fake(folder)
