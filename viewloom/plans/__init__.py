"""The SQL surface: views and table functions registered over view and datapoint tables."""
