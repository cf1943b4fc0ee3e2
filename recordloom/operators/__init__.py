"""Blocking, vectors, features, decision rules, evaluation and audits as DataFrame operators."""
