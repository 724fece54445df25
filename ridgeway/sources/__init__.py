"""Where tables come from and where run metrics and staged tables go."""
