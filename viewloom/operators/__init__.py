"""DataFrame operators over view tables and datapoint tables."""
