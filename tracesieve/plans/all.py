"""Imports all queries."""

from tracesieve.plans import artifacts, budgets, caches, chat, contracts, corpus, judging, links, logs, machines, prompts, records, responses, seams  # noqa: F401
