"""Operators for preparing training corpora, each by the method its module names."""
