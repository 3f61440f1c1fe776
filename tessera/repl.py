"""An interactive prompt: statements end with a semicolon, results are printed as lines of JSON."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.session import Session

PROMPT, MORE = "> ", ". "


def split_statements(text: str) -> tuple[list[str], str]:
    """Complete statements and what is left; a semicolon within quotes ends none."""
    out, start, quoted, i = [], 0, False, 0
    while i < len(text):
        c = text[i]
        if quoted and c == "\\":
            i += 1
        elif c == '"':
            quoted = not quoted
        elif c == ";" and not quoted:
            out.append(text[start:i])
            start = i + 1
        i += 1
    return out, text[start:]


def rows_as_json(df) -> list[str]:  # noqa: ANN001
    """Each row as a line of JSON, in the order of the result, a partition at a time."""
    one = df.columns == ["value"]
    line = F.to_json(F.struct(F.col("value"))) if one else F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    for r in df.select(line.alias("x")).toLocalIterator():
        yield r["x"]


def main(spark: SparkSession | None = None, lines=None, write=print) -> None:  # noqa: ANN001
    session = Session(spark or SparkSession.builder.getOrCreate())
    rest = ""
    source = lines if lines is not None else sys.stdin
    if lines is None:
        print(PROMPT, end="", flush=True)
    for line in source:
        statements, rest = split_statements(rest + line)
        for s in statements:
            if not s.strip():
                continue
            try:
                result = session.query(s + ";")
                if result is not None:
                    for x in rows_as_json(result):
                        write(x)
            except Exception as e:  # noqa: BLE001 - the prompt goes on after an error
                write(f"{type(e).__name__}: {e}")
        if lines is None:
            print(MORE if rest.strip() else PROMPT, end="", flush=True)


if __name__ == "__main__":
    main()
