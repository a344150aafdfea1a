"""DataFrame operators: event-time ordering, watermarks, changelogs, routing, audits."""
