"""What runs on executors travels with its code: no function imports the package where it runs."""

import re
from pathlib import Path


def test_no_imports_of_the_package_within_functions():
    for path in (Path(__file__).resolve().parent.parent / "ledgerline").rglob("*.py"):
        assert not re.search(r"^[ \t]+(from|import) ledgerline", path.read_text(), re.M), path
