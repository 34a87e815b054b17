"""Streaming.

The reference has no streams, watermarks or stateful operators, so this
package holds none.  All operators of the library take plain DataFrames;
the row-local ones (``functions``) also accept streaming DataFrames.
"""
