"""Named queries over the landed tables, each with its SQL counterpart where SQL can state it."""
