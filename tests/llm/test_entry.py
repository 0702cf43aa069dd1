"""The entry module does not hide errors of the operators."""

from __future__ import annotations

from tests.test_entry import run


def test_missing_modules_of_its_own_are_errors():
    done = run("payrisk.llm.text")
    assert done.returncode != 0 and "payrisk.llm.text" in done.stderr
