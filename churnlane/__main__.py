from churnlane.cli import main

main()
