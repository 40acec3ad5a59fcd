"""Analyses as DataFrame -> DataFrame functions; nothing here runs a job unless its docstring says so."""
