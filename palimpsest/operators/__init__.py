"""Operators over revision rows and over file lists; DataFrames in and out."""
