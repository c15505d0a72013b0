"""Inputs for the catalog's queries that the sales tables lack: outreach records derived from
the customers, and stand-ins for services."""
