"""Where events, entries, identities, tasks and codes are read from."""
