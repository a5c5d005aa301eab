"""Transformations from DataFrame to DataFrame. All are lazy unless their name says otherwise."""
