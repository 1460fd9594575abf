"""DataFrame operators: studies, encoders, splits, ranks, metrics, segments."""
