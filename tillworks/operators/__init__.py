"""DataFrame operators: joins, modes, numbering, latest rows, histories."""
