"""DataFrame -> DataFrame operators of the preference engine."""
