"""DataFrame -> DataFrame operators for experiment and uplift analytics."""
