"""Operators for preparing training corpora: one module each, plus ``queries`` that registers them."""
