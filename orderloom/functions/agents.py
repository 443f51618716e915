"""User-agent classification by ordered substring rules."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class AgentRule(NamedTuple):
    label: str
    any_of: tuple[str, ...]
    none_of: tuple[str, ...] = ()


# The first rule that matches wins, so the order matters.
DEVICE_RULES = (
    AgentRule("Mobile", ("iPhone", "Android")),
    AgentRule("Tablet", ("iPad",)),
)
BROWSER_RULES = (
    AgentRule("Chrome", ("Chrome",), ("Edg/",)),
    AgentRule("Safari", ("Safari",), ("Chrome",)),
    AgentRule("Firefox", ("Firefox",)),
    AgentRule("Edge", ("Edg/",)),
)
SYSTEM_RULES = (
    AgentRule("Windows", ("Windows",)),
    AgentRule("macOS", ("Mac OS",)),
    AgentRule("Android", ("Android",)),
    AgentRule("iOS", ("iPhone", "iPad")),
)
DEVICE_CATEGORIES = ("Mobile", "Tablet", "Desktop")
BROWSERS = ("Chrome", "Safari", "Firefox", "Edge", "Other")
SYSTEMS = ("Windows", "macOS", "Android", "iOS", "Other")


def classify_agent(agent: Column | str, rules: Sequence[AgentRule], default: str) -> Column:
    text = F.col(agent) if isinstance(agent, str) else agent
    branches = None
    for rule in rules:
        hit = F.lit(False)
        for token in rule.any_of:
            hit = hit | text.contains(token)
        for token in rule.none_of:
            hit = hit & ~text.contains(token)
        branches = F.when(hit, rule.label) if branches is None else branches.when(hit, rule.label)
    return F.lit(default) if branches is None else branches.otherwise(default)


def device_category(agent: Column | str) -> Column:
    return classify_agent(agent, DEVICE_RULES, "Desktop")


def browser_name(agent: Column | str) -> Column:
    return classify_agent(agent, BROWSER_RULES, "Other")


def operating_system(agent: Column | str) -> Column:
    return classify_agent(agent, SYSTEM_RULES, "Other")


def is_mobile(category: Column | str) -> Column:
    c = F.col(category) if isinstance(category, str) else category
    return F.coalesce(c.isin("Mobile", "Tablet"), F.lit(False))
