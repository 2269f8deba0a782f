"""The engine's queries over the given test tables, with one SQL oracle per query."""
