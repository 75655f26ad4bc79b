"""All registered queries; importing this package fills the registry."""

from lakeshelf.queries import aggregates, gold, joins, plans, rows, scalars, tables, udfs  # noqa: F401
