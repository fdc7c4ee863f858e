"""Operators for preparing training text, one module each. Nothing outside imports this
package; ``queries`` has the registered queries and their SQL."""
