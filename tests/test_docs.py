"""The README's operator inventory names every registered query."""

import os
import re

from cadence.plans.registry import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_readme_inventory_lists_every_query():
    text = open(os.path.join(ROOT, "README.md")).read()
    inventory = text.split("## Operator inventory", 1)[1].split("\n## ", 1)[0]
    named = set(re.findall(r"`([a-z0-9_]+)`", inventory))
    missing = set(QUERIES) - named
    assert not missing, missing
