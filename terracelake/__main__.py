from terracelake.cli import main

main()
