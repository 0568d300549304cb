import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tenderlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        spark__sql__shuffle__partitions="4", spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect a frame as a sorted list of tuples."""

    def collect(df, *columns):
        found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))

    return collect


@pytest.fixture
def write_csv(tmp_path):
    """Write a landing file the way the source does: Latin-1, semicolons, quoted as needed."""
    folder = tmp_path / "landing"
    folder.mkdir()

    def write(name, header, *lines):
        text = "\n".join([";".join(header), *[";".join(line) for line in lines]]) + "\n"
        (folder / name).write_text(text, encoding="latin-1")
        return str(folder)

    write.folder = str(folder)
    return write
