"""Operators for preparing language-model training data.

Each module holds one operator with a general interface over DataFrames;
``queries`` registers one thin query per operator. Nothing outside this
package imports it.
"""
