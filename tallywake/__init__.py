"""Event-time analytics over user-behaviour events, in batch and as streams.

Every operator is a function from DataFrame to DataFrame.
"""
