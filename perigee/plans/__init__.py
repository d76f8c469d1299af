"""Marts, the rollup behind them, and the jobs that write them."""
