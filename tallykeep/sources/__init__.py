"""Adapters that build a :class:`tallykeep.model.SalesModel`, and result sinks."""
